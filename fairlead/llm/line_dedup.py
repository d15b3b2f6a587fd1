"""Removal of lines that many documents repeat, as keep bitmaps per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import SPACE_CHARS, let, row_hash
from fairlead.sources.stages import StageStore

# --- Fixed values: letters that a line key folds ---
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# --- End of fixed values ---


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    """Lines of a text; a null text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def long_lines(docs: DataFrame, min_chars: int, salts: int) -> DataFrame:
    """One row per line whose key is long enough: key hashes, salt, row, position.

    Two hashes with different seeds stand for the key (128 bits).
    """
    lines = docs.select(
        F.col("doc_id"), "row", F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    ).where(F.length("line") >= min_chars)
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(salts)).cast("int").alias("salt"),
        "doc_id",
        "row",
        "pos",
    )


def kept_runs(n_lines: Column, dropped: Column) -> Column:
    """Run-length form of the keep bitmap: runs (start, length) of kept lines."""
    def between(edges: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(edges) - 1),
            lambda i: F.struct(
                (F.get(edges, i - 1) + 1).alias("start"),
                (F.get(edges, i) - F.get(edges, i - 1) - 1).alias("length"),
            ),
        )

    runs = let(F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines)), between)
    return F.filter(runs, lambda r: r["length"] > 0)


def keep_bitmaps(
    docs: DataFrame,
    store: StageStore,
    min_chars: int = 40,
    min_docs: int = 5,
    salts: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc_id, row, dropped, n_dropped.

    A key of at least ``min_chars`` code points that at least ``min_docs``
    documents hold loses all its lines except those of the largest document id.
    ``dropped`` lists the positions in order, ``row`` is the hash that tells
    rows of one id apart. Documents without a loss have no row here.

    Key hashes are range-partitioned together with a salt of the document and
    sorted by document and position, so that one key held by a third of all
    documents spreads over ``salts`` ranges. The stream over each range gives
    its first occurrence and number of documents; these few rows are added up
    by key and written, so that the join back to the lines can split a hot key
    as well. A null id counts as one document before all others; equal rows of
    one id count once.
    """
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).alias("text"),
        row_hash(F.col(text_col)).alias("row"),
    )
    occurrences = long_lines(slim, min_chars, salts)
    ranged = occurrences.repartitionByRange("h1", "h2", "salt")
    order = Window.partitionBy("h1", "h2", "salt").orderBy(
        F.col("doc_id").desc_nulls_last(), "row", "pos"
    )
    earlier = F.lag("doc_id").over(order)
    first = F.row_number().over(order) == 1
    streamed = ranged.select(
        "h1",
        "h2",
        F.when(first, F.col("doc_id")).alias("holder"),
        (first | ~earlier.eqNullSafe(F.col("doc_id"))).cast("int").alias("new_doc"),
    )
    repeated = store.keep(
        streamed.groupBy("h1", "h2")
        .agg(F.sum("new_doc").alias("n_docs"), F.max("holder").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "repeated_lines",
    )
    losses = occurrences.join(repeated, ["h1", "h2"]).where(
        ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    )
    return (
        losses.groupBy("doc_id", "row")
        .agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
        .withColumn("n_dropped", F.size("dropped"))
    )


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with n_lines, n_dropped and kept runs."""
    left = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).cast("bigint").alias("left_id"),
        row_hash(F.col(text_col)).alias("left_row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("whole"),
        F.size(split_lines(F.col(text_col))).alias("n_lines"),
    )
    matched = F.col("left_id").eqNullSafe(F.col("doc_id")) & (F.col("left_row") == F.col("row"))
    return left.join(bitmaps, matched, "left").select(
        "doc",
        "left_id",
        "whole",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("n_dropped").isNotNull(), kept_runs(F.col("n_lines"), F.col("dropped"))).alias(
            "kept_runs"
        ),
    )


def kept_text(whole: Column, runs: Column) -> Column:
    """The text without its dropped lines; ``runs`` is null where none is dropped."""
    pieces = let(
        F.split(whole, "\n"),
        lambda lines: F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"])),
    )
    return F.when(runs.isNull(), whole).otherwise(F.array_join(F.flatten(pieces), "\n"))


def drop_repeated_lines(
    docs: DataFrame, store: StageStore, id_col: str = "doc_id", text_col: str = "text", **limits
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text column.

    All columns and rows stay; a null text stays null, a text that loses all
    its lines becomes empty.
    """
    bitmaps = keep_bitmaps(docs, store, id_col=id_col, text_col=text_col, **limits)
    joined = with_bitmaps(docs, bitmaps, id_col, text_col)
    text = F.when(
        F.col("doc")[text_col].isNotNull(), kept_text(F.col("whole"), F.col("kept_runs"))
    )
    return joined.select(
        *(text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns)
    )
