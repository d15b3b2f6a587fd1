"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the top bits choose a bin and each bin keeps its
smallest hash. An empty bin borrows from the bin that a sequence of hashes of
its own number first finds filled (optimal densification). The low bits of
the bins are packed; likeness is the share of equal bins, corrected for equality
by chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.token_arrays import mix, shingles, split_words, text_slices

BINS = 256
BITS = 4
WIDTH = 5
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def densify(bins: np.ndarray) -> np.ndarray:
    """Fills empty bins of each row; rows without any filled bin stay empty."""
    out = bins.copy()
    rows, places = np.nonzero((bins == NONE) & (bins != NONE).any(axis=1)[:, None])
    attempt = 0
    k = bins.shape[1]
    while len(rows):
        attempt += 1
        tried = mix(places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        found = bins[rows, (tried % np.uint64(k)).astype(np.int64)]
        filled = found != NONE
        out[rows[filled], places[filled]] = found[filled]
        rows, places = rows[~filled], places[~filled]
    return out


def sketch(data: np.ndarray, offsets: np.ndarray, k: int = BINS, bits: int = BITS) -> np.ndarray:
    """Low bits of all bins, one row per text; -1 in every bin of a text without words."""
    n = len(offsets) - 1
    hashes, texts = shingles(split_words(data, offsets, lower=True), WIDTH)
    shift = np.uint64(64 - int(math.log2(k)))
    place = (hashes >> shift).astype(np.int64) + texts * k
    bins = np.full(n * k, NONE)
    order = np.lexsort((hashes, place))
    place, hashes = place[order], hashes[order]
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    bins[place[first]] = hashes[first]
    full = densify(bins.reshape(n, k))
    low = (mix(full) & np.uint64((1 << bits) - 1)).astype(np.int16)
    low[full == NONE] = -1
    return low


def packed_hex(low: np.ndarray, bits: int = BITS) -> list[str]:
    """Packed bits as hex; an empty string for a text without words."""
    shifts = np.arange(bits - 1, -1, -1)
    packed = np.packbits(((low[:, :, None] >> shifts) & 1).astype(np.uint8).reshape(len(low), -1), axis=1)
    return ["" if row[0] < 0 else p.tobytes().hex() for row, p in zip(low, packed, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated share of common shingles; 1 for two texts without words, 0 for one."""
    chance = 2.0**-bits
    equal = (a == b).mean(axis=1)
    estimate = np.clip((equal - chance) / (1 - chance), 0, 1)
    empty_a, empty_b = a[:, 0] < 0, b[:, 0] < 0
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), estimate)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# --- Ranges of documents in order -------------------------------------------

#: Keys sampled per range to find the cuts.
SAMPLED_PER_RANGE = 20
KEY = ("is_null", "down", "opening", "digest")
OPENING = 32


def with_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) and the columns that order them: descending id, nulls last, then text.

    ``down`` falls as the id grows and is never null. Texts of one id are
    ordered by their first characters (without U+0000, which numpy drops), then
    by a digest. ``row`` differs for every row, also for equal ones.
    """
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return slim.withColumns(
        {
            "is_null": F.col("doc_id").isNull(),
            "down": F.bitwise_not(F.coalesce("doc_id", F.lit(0))),
            "opening": F.translate(F.left("text", F.lit(OPENING)), "\0", ""),
            "digest": F.xxhash64("text"),
            "row": F.monotonically_increasing_id(),
        }
    )


def key_array(is_null, down, opening, digest) -> np.ndarray:
    """The key columns as one array of comparable records."""
    kinds = ("?", "<i8", f"<U{OPENING}", "<i8")
    keys = np.empty(len(down), list(zip(KEY, kinds, strict=True)))
    for name, column in zip(KEY, (is_null, down, opening, digest), strict=True):
        keys[name] = column
    return keys


def cuts_of(keyed: DataFrame, bytes_per_range: int, most_ranges: int) -> np.ndarray:
    """Keys that cut the documents into ranges of about equal size in bytes.

    Found from a sample of at most some twenty keys a range. A key that holds
    more than a range (one id and text in many rows) is cut several times.
    """
    n, size = keyed.agg(F.count("*"), F.sum(F.octet_length("text") + 1)).first()
    ranges = min(most_ranges, math.ceil((size or 0) / bytes_per_range))
    if ranges < 2:
        return key_array([], [], [], [])
    step = max(1, n // (ranges * SAMPLED_PER_RANGE))
    weighed = keyed.select(*KEY, (F.octet_length("text") + 1).alias("size"), "row")
    rows = weighed.where(F.pmod(F.xxhash64("row"), F.lit(step)) == 0).limit(2 * ranges * SAMPLED_PER_RANGE).collect()
    keys = key_array(*([r[name] for r in rows] for name in KEY))
    order = np.argsort(keys, order=KEY, kind="stable")
    passed = np.cumsum(np.array([r["size"] for r in rows], float)[order])
    at = np.searchsorted(passed, passed[-1] * np.arange(1, ranges) / ranges)
    return keys[order][at]


def ranges_of(keys: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Range of each key: the number of cuts below it.

    A key that is itself cut lies on both sides of its cuts: its rows are dealt
    to all ranges that touch it, by their number.
    """
    first = np.searchsorted(cuts, keys, side="left")
    beyond = np.searchsorted(cuts, keys, side="right")
    return (first + rows % (beyond - first + 1)).astype(np.int32)


def with_next_document(
    docs: DataFrame, bytes_per_range: int, most_ranges: int, id_col: str, text_col: str
) -> DataFrame:
    """Rows dealt to ranges in order, each range with the first row of the next as guest.

    The cuts and the number of the first row of each range, at most
    ``most_ranges``, come to the driver. The last range has the first row of
    all as guest.
    """
    keyed = with_keys(docs, id_col, text_col)
    cuts = cuts_of(keyed, bytes_per_range, most_ranges)

    @F.pandas_udf("int")
    def own_range(is_null: pd.Series, down: pd.Series, opening: pd.Series, digest: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(ranges_of(key_array(is_null, down, opening, digest), row.to_numpy(), cuts))

    ranged = keyed.withColumn("own", own_range(*KEY, "row") if len(cuts) else F.lit(0))
    found = ranged.groupBy("own").agg(F.min(F.struct(*KEY, "row"))["row"].alias("first")).collect()
    firsts = {r["own"]: r["first"] for r in found}
    order = sorted(firsts)
    visits = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # number of a first row -> the range it visits

    @F.pandas_udf("array<int>")
    def visited(own: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([[r, visits[i]] if i in visits else [r] for r, i in zip(own, row, strict=True)])

    return ranged.select(*KEY, "row", "doc_id", "text", F.posexplode(visited("own", "row")).alias("guest", "range"))


OUTPUT = (
    "doc_id bigint, n_chars bigint, edited string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def compare_rows(rows: list[tuple[int, str]], following: str) -> pa.RecordBatch:
    """Output of consecutive rows; ``following`` is the text after the last."""
    texts = [t for _, t in rows]
    nexts = [*texts[1:], following]
    changed = [edited(t, f) for t, f in zip(texts, nexts, strict=True)]

    def sketches(items: list[str]) -> np.ndarray:
        return np.concatenate(
            [sketch(data, offsets) for _, _, data, offsets in text_slices(pa.array(items, pa.large_string()))]
        )

    own = sketches([*texts, following])
    other = sketches(changed)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in rows], pa.int64()),
            pa.array(map(len, texts), pa.int64()),
            pa.array(changed, pa.string()),
            pa.array(packed_hex(own[:-1]), pa.string()),
            pa.array(packed_hex(other), pa.string()),
            pa.array(likeness(own[:-1], other), pa.float64()),
            pa.array(likeness(own[:-1], own[1:]), pa.float64()),
        ],
        names=[c.split(" ")[0] for c in OUTPUT.split(", ")],
    )


def fingerprint_documents(
    docs: DataFrame,
    bytes_per_range: int = 8 << 20,
    most_ranges: int = 10_000,
    batch_chars: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness.

    The edited text has its last floor(n / 2) characters replaced by the first as
    many (or all) of the next document in descending id; the last is followed
    by the first, a single one by itself. Columns: doc_id, n_chars, edited,
    fingerprint, edited_fingerprint (hex), near_edited, near_next. A null text
    counts as empty; texts without words have the empty fingerprint, likeness 1
    to each other and 0 to others. Null ids come last, rows of one id are
    ordered by the first characters of the text and then by its digest, equal
    rows follow one another. Equal texts
    have equal fingerprints. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive by range, each range ends with its guest.
        held: list[tuple[int, str]] = []
        size = 0
        for batch in batches:
            columns = (batch.column(i) for i in range(3))
            for doc_id, text, guest in zip(*columns, strict=True):
                doc_id, text = doc_id.as_py(), text.as_py()
                if held and (guest.as_py() or size >= batch_chars):
                    yield compare_rows(held, text)
                    held, size = [], 0
                if not guest.as_py():
                    held.append((doc_id, text))
                    size += len(text)
        if held:
            raise RuntimeError(f"a range of documents ends without the next one; {len(held)} rows would be lost")

    dealt = with_next_document(docs, bytes_per_range, most_ranges, id_col, text_col)
    ordered = dealt.repartition("range").sortWithinPartitions("range", "guest", *KEY, "row")
    return ordered.select("doc_id", "text", "guest").mapInArrow(run, OUTPUT)
