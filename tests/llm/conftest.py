from __future__ import annotations

import pytest

from fairlead.llm.stages import Stages

#: Columns whose names the operators use themselves.
CLASHING = (
    "row string, place string, shard int, size int, key string, gram int, starts string, h1 int,"
    " taken int, passes int, turn int, tokens string, lines string, dropped string, kept boolean,"
    " band int, rep int, component string, score double, label int, range int, guest int, doc int,"
    " whole string, n int, w int, a int, b int, left_id int, part string"
)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} filler{i % 31}" for i in range(60_000))
LINE = "This line of more than forty characters repeats in many documents."

#: Nulls in every column, empty, blank and very long texts, repeated rows and ids.
ROWS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "web", 3),
    (2, None, None, None, None),
    (3, "", "en", "web", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "", 7),
    (5, LONG, "en", "books", len(LONG)),
    (6, "two\nlines Straße ÄÖ naïve 漢字 <|endoftext|>", "de", None, 9),
    (7, "same text here", "en", "web", 14),
    (7, "same text here", "en", "web", 14),
    (8, "same text here", "en", "web", 14),
    (9, "same id, first text", "en", "web", 1),
    (9, "same id, other text", "en", "web", 1),
    (None, "no id at all", "en", "web", 1),
    (None, None, None, None, None),
    *((20 + i, f"start {i}\n{LINE}\n  {LINE.upper()} \nend {i}", "en", "web", 1) for i in range(6)),
]


@pytest.fixture(scope="session")
def edge_rows():
    return ROWS


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows above with further columns of clashing names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, SCHEMA)
    extra = [c.strip().split(" ") for c in CLASHING.split(",")]
    return docs.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in extra))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(texts, source="web"):
        rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def store(spark, tmp_path):
    return Stages(spark, str(tmp_path / "stages"))
