"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from fairlead.llm import bpe, catalogue, classifier, oracle
from fairlead.llm.common import documents
from tests.conftest import SMALL
from tests.llm.test_native_operators import brute_lines
from tests.llm.test_python_operators import brute_components, tokens_of
from tests.oracle_check import compare, connect

COLUMNS = {
    "op1_hash_tree_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op5_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op9_fingerprints": {
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    },
}

#: Rows of the queries with SQL that do not give one per document.
ROWS = {"op11_conversation_repair": 20, "op12_embedding_dedup": 500, "op13_filter_audit": 12_000}


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    rows, problem = compare(spark, connect(SMALL), SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and rows == ROWS.get(name, 200)


def test_all_are_registered():
    assert set(catalogue.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(catalogue.queries()) == set(oracle.oracle_sql()) | set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_other_queries_give_a_row_per_document(spark, name):
    df = catalogue.queries()[name](spark, SMALL)
    assert set(df.columns) == COLUMNS[name]
    assert Counter(r.doc_id for r in df.select("doc_id").collect()) == Counter(range(200))


def test_pipeline_stages_match_brute_force(spark, store):
    kept = {}
    docs = documents(spark, SMALL)
    start = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = store.keep(stage(spark, docs, SMALL), name)
        kept[name] = docs.collect()
        if name != "bpe_encoding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    model = classifier.fit(documents(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = classifier.scores(pa.array([r[1] for r in start]), model) >= 0.5
    first = [r for r, g in zip(start, good, strict=True) if g]
    assert sorted(map(tuple, kept["quality_classifier"])) == sorted(first)

    lines = {(d, text) for d, _, _, text in brute_lines(first)}
    assert {(r.doc_id, r.text) for r in kept["line_dedup"]} == lines

    heads = {component for _, _, component in brute_components([(d, t) for d, t in sorted(lines)])}
    assert {r.doc_id for r in kept["near_dedup"]} == heads
    texts = dict(lines)
    assert all(r.text == texts[r.doc_id] for r in kept["near_dedup"])

    con = duckdb.connect()
    unmixed = [r.asDict() for r in kept["near_dedup"]]
    con.register("documents", pa.Table.from_pylist(unmixed))
    taken = {d: n for d, n in con.execute(f"SELECT doc_id, taken FROM ({oracle.MIXING})").fetchall() if n}
    mixed = Counter()
    for r in kept["source_mixing"]:
        mixed[r.doc_id] += len(tokens_of(r.text))
        assert r.n_chars == len(r.text)
        assert set(tokens_of(r.text)) <= set(tokens_of(texts[r.doc_id]))
    assert mixed == taken

    coder = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encoded = Counter((r.doc_id, bytes(r.ids)) for r in kept["bpe_encoding"])
    assert encoded == Counter((r.doc_id, coder.encode(r.text)) for r in kept["source_mixing"])
    assert all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in kept["bpe_encoding"])


def test_pipeline_decodes_what_it_encodes(spark, make_docs):
    """The last stage is the whole method: ids and the text they decode to."""
    texts = ["Hello, world 42!", None, "", "naïve <|endoftext|> 漢字"]
    rows = corpus_pipeline.bpe_encoding(spark, make_docs(texts), SMALL).collect()
    coder = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id: (bytes(r.ids), r.decoded) for r in rows} == {
        i: (coder.encode(t or ""), coder.decode(coder.encode(t or ""))) for i, t in enumerate(texts)
    }


def test_pipeline_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL).agg(F.count("*"), F.sum("n_tokens")).first()
    assert rows[0] > 0 and rows[1] > 0
