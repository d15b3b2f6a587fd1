"""Language-model scores of documents by stupid backoff, computed relationally.

Runs of up to ``order`` words are counted into tables partitioned by their hash.
A word scores count(run that ends with it) / count(that run without it), with the
longest context that was counted; each word dropped from the context costs the
factor ``discount``, and without context a word scores count / all words. Every
count is kept, also of runs seen once. Documents are exploded into distinct runs
with weights, joined to the tables on the hash, and logarithms are added up by
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.stages import Stages
from fairlead.llm.token_arrays import BASE, SLICE_BYTES, Words, mix, split_words, text_slices

NO_ID = -(1 << 63)
HASH_JOIN_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
#: Shuffled bytes of a part that a task may hold as a hash table; Spark wants its advisory size or more.
HASHED_PART_BYTES = 64 << 20

#: (text, run hash, weight) of the runs of some texts.
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def tallied(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[list, list]:
    """Rows of ``keys`` with the sums of ``weights``, equal rows added up.

    Rows are sorted by one number made of their keys. Where two different rows
    share that number, a row may come in several parts; whoever adds up the
    parts of other slices adds up these as well.
    """
    number = keys[0].astype(np.uint64)
    for k in keys[1:]:
        number = mix(number * np.uint64(BASE) + k)
    order = np.argsort(number)
    keys = [k[order] for k in keys]
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    opens = np.flatnonzero(fresh)
    sums = [np.add.reduceat(w[order], opens) if len(opens) else w[:0] for w in weights]
    return [k[opens] for k in keys], sums


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def all_runs(words: Words, order: int) -> Runs:
    """Every run of up to ``order`` words, each of weight one."""
    windows = [words.windows(width) for width in range(1, order + 1)]
    texts = np.concatenate([words.texts[first] for _, first in windows])
    return texts, np.concatenate([h for h, _ in windows]), np.ones(len(texts), np.int64)


def weighted_runs(words: Words, order: int) -> Runs:
    """Weights such that a counted text scores the sum of weight * ln(count) - ln(all words).

    Where nothing backs off, the ratios over consecutive words cancel except for the runs
    of ``order`` words and, below the line, the shorter runs inside the text. A
    text of fewer words is one run.
    """
    starts, ends = words.bounds[:-1], words.bounds[1:]
    hashes, first = words.windows(order)
    parts = [(words.texts[first], hashes, np.ones(len(first), np.int64))]
    hashes, first = words.windows(order - 1)
    texts = words.texts[first]
    inside = (first > starts[texts]) & (first + order - 1 < ends[texts])
    parts.append((texts[inside], hashes[inside], np.full(int(inside.sum()), -1, np.int64)))
    for width in range(1, order):
        hashes, first = words.windows(width)
        texts = words.texts[first]
        whole = ends[texts] - starts[texts] == width
        parts.append((texts[whole], hashes[whole], np.ones(int(whole.sum()), np.int64)))
    texts, hashes, weights = map(np.concatenate, zip(*parts, strict=True))
    return texts, hashes, weights


def hash_part(gram: Column, parts: int) -> Column:
    """Part of a run: its hash, which is unsigned, modulo ``parts``."""
    return F.pmod(gram + F.when(gram < 0, F.lit((1 << 64) % parts)).otherwise(F.lit(0)), F.lit(parts))


@contextmanager
def hash_joins(spark: SparkSession) -> Iterator[None]:
    """Lets adaptive execution join by hash where all parts of the smaller side are small.

    Larger ones are sorted and may spill, as before.
    """
    before = spark.conf.get(HASH_JOIN_BYTES, "0")
    spark.conf.set(HASH_JOIN_BYTES, str(HASHED_PART_BYTES))
    try:
        yield
    finally:
        spark.conf.set(HASH_JOIN_BYTES, before)


def found(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is in the sorted ``table``, and where."""
    if not len(table):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return table[at] == hashes, at


def tallied_runs(docs: DataFrame, order: int) -> DataFrame:
    """(gram, n): runs of (doc_id, text) rows, added up over slices of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(1), 2 * SLICE_BYTES):
                _, hashes, ones = all_runs(split_words(data, offsets, lower=False), order)
                (gram,), (n,) = tallied([hashes], [ones])
                yield pa.RecordBatch.from_arrays([signed(gram), pa.array(n)], names=["gram", "n"])

    return docs.mapInArrow(run, "gram bigint, n bigint")


def tallied_contexts(docs: DataFrame, order: int) -> DataFrame:
    """(width, gram, front, back, inner, n): runs with the runs they hold.

    ``front`` lacks the last word, ``back`` the first, ``inner`` both; null where
    nothing is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(1)):
                words = split_words(data, offsets, lower=False)
                at = {}
                for width in range(1, order + 1):
                    hashes, first = words.windows(width)
                    at[width] = np.zeros(len(words.hashes) + 1, np.uint64)
                    at[width][first] = hashes
                    none = pa.nulls(len(first), pa.int64())
                    held = [
                        signed(at[w][first + skip]) if w else none
                        for w, skip in ((width - 1, 0), (width - 1, 1), (max(width - 2, 0), 1))
                    ]
                    rows = pa.table([signed(hashes), *held], names=["gram", "front", "back", "inner"])
                    counted = rows.group_by(rows.column_names).aggregate([([], "count_all")])
                    counted = counted.rename_columns([*rows.column_names, "n"])
                    widths = pa.array(np.full(len(counted), width, np.int32))
                    yield from counted.add_column(0, "width", widths).combine_chunks().to_batches()

    return docs.mapInArrow(
        run, "width int, gram bigint, front bigint, back bigint, inner bigint, n bigint"
    )


def exploded_runs(
    docs: DataFrame,
    runs_of: Callable[[Words, int], Runs],
    order: int,
    part: int,
    parts: int,
    frequent: Broadcast | None = None,
) -> DataFrame:
    """(doc_id, gram, n): weights of the distinct runs of every row in one hash part, but the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1)):
                texts, hashes, weights = runs_of(split_words(data, offsets, lower=False), order)
                here = hashes % np.uint64(parts) == part
                texts, hashes, weights = texts[here], hashes[here], weights[here]
                if frequent is not None:
                    other = ~found(frequent.value[0], hashes)[0]
                    texts, hashes, weights = texts[other], hashes[other], weights[other]
                (texts, gram), (n,) = tallied([texts, hashes], [weights])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start).take(pa.array(texts)), signed(gram), pa.array(n)],
                    names=["doc_id", "gram", "n"],
                )

    return docs.mapInArrow(run, "doc_id bigint, gram bigint, n bigint")


def text_totals(
    docs: DataFrame, order: int, runs_of: Callable[[Words, int], Runs] | None = None, frequent: Broadcast | None = None
) -> DataFrame:
    """(doc_id, n_words, n_texts, n_longer, known) of every row.

    n_texts is 1 for a text with words, n_longer counts its runs of 2 to
    ``order`` words, known is what its frequent runs add to the score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1)):
                words = split_words(data, offsets, lower=False)
                n = np.diff(words.bounds).astype(np.int64)
                longer = sum(np.maximum(n - width, 0) for width in range(1, order))
                known = np.zeros(len(n))
                if frequent is not None:
                    table, logs = frequent.value
                    texts, hashes, weights = runs_of(words, order)
                    hit, at = found(table, hashes)
                    known = np.bincount(texts[hit], weights[hit] * logs[at[hit]], len(n)).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        *map(pa.array, (n, (n > 0).astype(np.int64), longer, known)),
                    ],
                    names=["doc_id", "n_words", "n_texts", "n_longer", "known"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_texts bigint, n_longer bigint, known double")


def most_frequent(counts: DataFrame, most: int) -> list[tuple[int, float]]:
    """(gram, log_count) of the runs above the least power of two that at most ``most`` runs reach.

    A histogram of 64 rows decides first, so no more than ``most`` rows come to the driver.
    """
    power = F.floor(F.log2(F.col("c").cast("double"))).cast("int")
    sizes = {r["power"]: r["n"] for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = 64, 0
    for exponent in range(63, 0, -1):
        held += sizes.get(exponent, 0)
        if held > most:
            break
        least = exponent
    if least > 63:
        return []
    rows = counts.where(F.col("c") >= F.lit(1 << least)).select("gram", F.ln("c").alias("log_count")).collect()
    return [(r["gram"], r["log_count"]) for r in rows]


def slim_docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
        F.col(text_col).alias("text"),
    )


def scored(sizes: DataFrame, parts: list[DataFrame], log_score: Callable[[Column], Column]) -> DataFrame:
    """Adds up the gains of all parts; ``log_score`` makes the score of a document's gain."""
    gained = reduce(DataFrame.unionAll, parts).groupBy("doc_id").agg(F.sum("gain").alias("gain"))
    score = log_score(F.coalesce("gain", F.lit(0.0)))
    return sizes.join(gained, "doc_id", "left").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        "n_words",
        score.alias("log_score"),
        F.try_divide(score, "n_words").alias("mean_log_score"),
    )


def document_totals(totals: DataFrame) -> DataFrame:
    """One row per id: rows of one id are scored as one document."""
    return totals.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in totals.columns if c != "doc_id"))


def score_documents(
    docs: DataFrame,
    store: Stages,
    counted: DataFrame | None = None,
    order: int = 2,
    discount: float = 0.4,
    hash_passes: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score), one row per id of ``docs``.

    Runs of words are counted over ``counted``, a table with the same columns;
    without it over ``docs`` themselves, where every run is counted, so nothing
    backs off and :func:`score_with_all_counts` gives the same scores with less
    work. A word that was never counted scores as if seen once without context.

    Words are compared as they are. Null and empty texts have no words, score 0
    and a null mean. Rows of one id are scored as one document (their runs do
    not go across rows); null ids form one document with a null id. No
    documents give no rows; if nothing was counted, all words count as one.

    A counted run of two or more words adds the logarithm of its score less that of
    what it would back off to, discount included. All positions are scored as
    if they backed off to the word alone, and as whatever a counted run holds
    was counted too, the gains of the runs that end at a word lead to its
    longest counted run. So each run meets the table on its own.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    if counted is None:
        return score_with_all_counts(docs, store, order, hash_passes, id_col=id_col, text_col=text_col)
    slim = slim_docs(docs, id_col, text_col)
    parts_of = ("width", "gram", "front", "back", "inner")
    table = store.keep(
        tallied_contexts(slim_docs(counted, id_col, text_col), order)
        .groupBy(*parts_of)
        .agg(F.ln(F.sum("n")).alias("log_count"), F.sum("n").alias("c")),
        "run_counts",
    )
    total = table.where("width = 1").agg(F.sum("c")).first()[0] or 1
    log_total, log_discount = F.ln(F.lit(float(total))), F.ln(F.lit(discount))
    longer = table.where("width > 1")
    for name in ("front", "back", "inner"):
        shorter = table.where(F.col("width") < order)
        longer = longer.join(shorter.select(F.col("gram").alias(name), F.col("log_count").alias(f"log_{name}")), name, "left")
    gain = (
        F.col("log_count") - F.col("log_front") - F.col("log_back") + F.coalesce("log_inner", log_total) - log_discount
    )
    gains = store.keep(
        table.where("width = 1").select("gram", F.col("log_count").alias("gain")).unionAll(longer.select("gram", gain.alias("gain"))),
        "run_gains",
    )
    sizes = store.keep(document_totals(text_totals(slim, order)), "sizes")
    parts = []
    for part in range(hash_passes):
        met = exploded_runs(slim, all_runs, order, part, hash_passes).join(gains, "gram")
        parts.append(store.keep(met.groupBy("doc_id").agg(F.sum(F.col("n") * F.col("gain")).alias("gain")), "gained"))
    return scored(
        sizes, parts, lambda gain: gain - F.col("n_words") * log_total + F.col("n_longer") * log_discount
    )


def score_with_all_counts(
    docs: DataFrame,
    store: Stages,
    order: int = 2,
    hash_passes: int = 2,
    frequent_runs: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) as :func:`score_documents` of the documents counted.

    Every run of words they hold has a count and scores count(run) / count(run
    without its last word); a word with fewer than ``order - 1`` words before it
    is scored after those. Runs counted once add ln(1) = 0 and need no row in
    the table, which loses nothing: what the table does not hold has count one.
    Counting takes one pass over the texts; its rows are added up by slice first.
    Joining takes ``hash_passes`` parts by hash, one after another. At most ``frequent_runs`` of the most frequent runs are sent to
    all tasks and looked up where the texts are read; all others are joined.
    Nulls, empty texts and repeated ids as there.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    slim = slim_docs(docs, id_col, text_col)
    counted = tallied_runs(slim, order).groupBy("gram").agg(F.sum("n").alias("c")).where("c > 1")
    table = store.keep(counted, "run_counts")
    top = sorted(most_frequent(table, frequent_runs), key=lambda r: r[0] % (1 << 64))
    frequent = store.spark.sparkContext.broadcast(
        (np.array([r[0] for r in top], np.int64).view(np.uint64), np.array([r[1] for r in top], np.float64))
    )
    sizes = store.keep(document_totals(text_totals(slim, order, weighted_runs, frequent)), "sizes")
    total = sizes.agg(F.sum("n_words")).first()[0] or 1
    parts = []
    for part in range(hash_passes):
        of_part = table.where(hash_part(F.col("gram"), hash_passes) == part)
        counts = of_part.select("gram", F.ln("c").alias("log_count"))
        met = exploded_runs(slim, weighted_runs, order, part, hash_passes, frequent).join(counts, "gram")
        gained = met.groupBy("doc_id").agg(F.sum(F.col("n") * F.col("log_count")).alias("gain"))
        with hash_joins(store.spark):
            parts.append(store.keep(gained, "gained"))
    log_total = F.ln(F.lit(float(total)))
    return scored(sizes, parts, lambda gain: gain + F.col("known") - F.col("n_texts") * log_total)
