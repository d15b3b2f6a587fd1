"""Removal of word passages that an earlier document already holds.

Equal windows lie in passages of one route. Where a route holds a single distinct
passage, its smallest document is the answer for all its windows. The passages of the
other routes make up reference shards: bounded sets of passages, each with the smallest
id of a document that holds it. A suffix automaton over the words of a shard knows for
every window the smallest id it occurs under. Passages run through the automaton
of their shard; what they match over the length threshold under a smaller id
becomes part of a span to remove. A route too large for a shard is told apart by
its single windows, which are grouped instead.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import row_hash
from fairlead.llm.token_arrays import IS_SPACE, Words, mix, split_words, text_slices, word_bounds
from fairlead.sources.stages import StageStore

WINDOW = 13
ANCHOR = 5
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Text bytes handled together; their arrays fit into a processor's cache.
PART_BYTES = 1 << 18


def anchors(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window: its first word, the word its anchor starts at, the anchor's hash.

    The anchor of a window is the run of ``anchor`` words with the smallest
    hash in it, so equal windows have equal anchors and neighbouring windows
    mostly share one.
    """
    n = len(words.hashes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    hashes, first = words.windows(anchor)
    best = np.full(n, NONE)
    best[first] = mix(hashes)
    place = np.arange(n)
    # The smallest of up to twice as many anchors at each step, the first of equal ones.
    covered, most = 1, window - anchor + 1
    while covered < most:
        by = min(covered, most - covered)
        lower = best[by:] < best[:-by]
        best, place = np.where(lower, best[by:], best[:-by]), np.where(lower, place[by:], place[:-by])
        covered += by
    starts = np.flatnonzero(words.texts[: n - window + 1] == words.texts[window - 1 :])
    return starts, place[starts], best[starts]


def anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(gram, doc_id, row): the distinct anchors of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(2), PART_BYTES):
                words = split_words(data, offsets, lower=False)
                first, _, grams = anchors(words, window, anchor)
                texts = words.texts[first]
                # Neighbouring windows mostly share an anchor; the rest is sorted by one number.
                fresh = np.ones(len(grams), bool)
                fresh[1:] = (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])
                grams, texts = grams[fresh], texts[fresh]
                order = np.argsort(mix(grams + mix(texts.astype(np.uint64))))
                grams, texts = grams[order], texts[order]
                fresh = np.ones(len(grams), bool)
                fresh[1:] = (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])
                where = pa.array(texts[fresh])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[fresh].view(np.int64)),
                        batch.column(0).slice(start, end - start).take(where),
                        batch.column(1).slice(start, end - start).take(where),
                    ],
                    names=["gram", "doc_id", "row"],
                )

    return docs.mapInArrow(run, "gram bigint, doc_id bigint, row bigint")


def single_spaced(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts with one space between words, and the byte range of each word there."""
    data = words.data.copy()
    kept = ~IS_SPACE[data]
    after = words.ends[words.ends < len(data)]
    after = after[~kept[after]]  # else the next text starts here
    kept[after] = True
    data[after] = 0x20
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    return data[kept].tobytes(), place[words.starts], place[words.ends]


def passages(hits: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, row, start, n, route, p1, p2, passage) around the shared anchors of each document.

    ``hits`` has (doc_id, row, text, grams), grams with the fields (gram, common).
    A passage covers the neighbouring windows of one anchor and goes where its
    anchor goes; for common anchors, which many documents hold, every window is
    a passage of its own and goes where its own hash goes. n counts the windows,
    p1 and p2 name the passage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(3)
            found_bounds, fields = found.offsets.to_numpy(), found.values.flatten()
            shared = fields[0].to_numpy().view(np.uint64)
            common = fields[1].to_numpy(zero_copy_only=False)
            for start, end, data, offsets in text_slices(batch.column(2), PART_BYTES):
                words = split_words(data, offsets, lower=False)
                first, place, grams = anchors(words, window, anchor)
                texts = words.texts[first]
                bounds = np.searchsorted(texts, np.arange(end - start + 1))
                held, alone = np.zeros(len(first), bool), np.zeros(len(first), bool)
                for i in range(end - start):
                    low, high = bounds[i : i + 2]
                    a, b = found_bounds[start + i : start + i + 2]
                    order = a + np.argsort(shared[a:b])
                    own = shared[order]
                    at = np.searchsorted(own, grams[low:high])
                    at[at == len(own)] = 0
                    held[low:high] = own[at] == grams[low:high]
                    alone[low:high] = common[order][at]
                where = np.flatnonzero(held)
                if not len(where):
                    continue
                alone = alone[where]
                # An anchor starts at one place, so neither texts nor gaps in between share one.
                opens = np.ones(len(where), bool)
                opens[1:] = (place[where[1:]] != place[where[:-1]]) | alone[1:]
                begins = where[opens]
                ends = where[np.append(np.flatnonzero(opens)[1:] - 1, len(where) - 1)]
                plain, word_starts, word_ends = single_spaced(words)
                low, high = word_starts[first[begins]], word_ends[first[ends] + window - 1]
                parts = [plain[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                names = b"".join([hashlib.blake2b(part, digest_size=16).digest() for part in parts])
                p1, p2 = np.frombuffer(names, "<i8").reshape(-1, 2).T
                whose = texts[begins]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start).take(pa.array(whose)),
                        batch.column(1).slice(start, end - start).take(pa.array(whose)),
                        pa.array(first[begins] - words.bounds[whose]),
                        pa.array(ends - begins + 1),
                        pa.array(np.where(alone[opens], p1, grams[begins].view(np.int64))),
                        pa.array(np.ascontiguousarray(p1)),
                        pa.array(np.ascontiguousarray(p2)),
                        pa.array(parts, pa.binary()).view(pa.string()),
                    ],
                    names=["doc_id", "row", "start", "n", "route", "p1", "p2", "passage"],
                )

    return hits.mapInArrow(
        run,
        "doc_id bigint, row bigint, start bigint, n bigint, route bigint, p1 bigint, p2 bigint, passage string",
    )


class SuffixAutomaton:
    """Suffix automaton of word sequences with the smallest id below each state.

    Every sequence is read from the start state, along what is known already, so
    no match crosses from one into the next.
    """

    def __init__(self, sequences: list[list], ids: list[int]):
        self.next = following = [{}]
        self.link = link = [-1]
        self.length = length = [0]
        self.least = least = [math.inf]
        for sequence, doc_id in zip(sequences, ids, strict=True):
            last = 0
            for symbol in sequence:
                p, step = last, following[last]
                last = step.get(symbol)
                if last is not None:
                    if length[last] != length[p] + 1:
                        last = self._split(p, symbol)
                    if doc_id < least[last]:
                        least[last] = doc_id
                    continue
                last = len(length)
                following.append({})
                link.append(0)
                length.append(length[p] + 1)
                least.append(doc_id)
                while symbol not in step:
                    step[symbol] = last
                    p = link[p]
                    if p < 0:
                        break
                    step = following[p]
                else:
                    q = step[symbol]
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, symbol)
        for state in np.argsort(length)[:0:-1].tolist():
            up = link[state]
            if least[state] < least[up]:
                least[up] = least[state]

    def _split(self, p: int, symbol) -> int:
        """A state of its own for what is read up to state ``p`` and ``symbol``."""
        following, link, length = self.next, self.link, self.length
        q = following[p][symbol]
        copy = len(length)
        following.append(following[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        self.least.append(math.inf)
        while p >= 0 and following[p].get(symbol) == q:
            following[p][symbol] = copy
            p = link[p]
        link[q] = copy
        return copy

    def least_ids(self, sequence: list, window: int) -> list[float]:
        """For every window of ``sequence``, the smallest id it occurs under, else infinity.

        The walk keeps the matching statistic: the longest suffix read so far
        that occurs in the automaton.
        """
        following, link, length, least = self.next, self.link, self.length, self.least
        out = []
        state = matched = 0
        for i, symbol in enumerate(sequence, 1):
            step = following[state].get(symbol)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = following[state].get(symbol)
            if step is not None:
                state = step
                matched += 1
            if i >= window:
                if matched < window:
                    out.append(math.inf)
                    continue
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                out.append(least[state])
        return out


def earliest(shards: DataFrame, window: int) -> DataFrame:
    """(p1, p2, runs): the smallest id of its shard that holds each window of a passage.

    A run (at, n, least) is n neighbouring windows of one smallest id.
    """

    def run(table: pa.Table) -> pa.Table:
        sequences = [t.split(" ") for t in table.column("passage").to_pylist()]
        automaton = SuffixAutomaton(sequences, table.column("doc_id").to_pylist())
        found = [np.array(automaton.least_ids(s, window), np.int64) for s in sequences]
        bounds = np.cumsum([0, *map(len, found)])
        least = np.concatenate(found)
        opens = np.ones(len(least), bool)
        opens[1:] = least[1:] != least[:-1]
        opens[bounds[:-1]] = True
        first = np.flatnonzero(opens)
        whose = np.searchsorted(bounds, first, side="right") - 1
        fields = {
            "at": (first - bounds[whose]).astype(np.int32),
            "n": np.diff(np.append(first, len(least))).astype(np.int32),
            "least": least[first],
        }
        runs = pa.StructArray.from_arrays(list(map(pa.array, fields.values())), names=list(fields))
        return pa.table(
            {
                "p1": table.column("p1"),
                "p2": table.column("p2"),
                "runs": pa.ListArray.from_arrays(pa.array(np.searchsorted(first, bounds).astype(np.int32)), runs),
            }
        )

    return shards.groupBy("shard").applyInArrow(
        run, "p1 bigint, p2 bigint, runs array<struct<at: int, n: int, least: bigint>>"
    )


def earliest_by_window(crowded: DataFrame, window: int) -> DataFrame:
    """(p1, p2, runs) as :func:`earliest`, by grouping the windows themselves; no group is held in memory."""
    tokens = F.split("passage", " ")
    at = F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")))
    windows = crowded.select("p1", "p2", "doc_id", tokens.alias("tokens"), at.alias("at")).select(
        "p1", "p2", "doc_id", "at", F.array_join(F.slice("tokens", F.col("at") + 1, window), " ").alias("window")
    )
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    placed = windows.drop("doc_id").join(least, "window").groupBy("p1", "p2")
    return placed.agg(F.collect_list(F.struct("at", F.lit(1).alias("n"), "least")).alias("runs"))


def repeated_windows(
    docs: DataFrame,
    store: StageStore,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    passages_per_shard: int = 4_000,
    common_docs: int = 1_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, row, runs): runs (first, n) of n neighbouring windows that an earlier document holds.

    ``row`` tells rows of one id apart. Anchors of windows are counted over all
    documents first; only documents with an anchor of at least two rows go on,
    and only the passages around such anchors. Distinct passages are gathered
    first, so copies, however many, cost one pass, and routes of one distinct passage
    need no automaton. A shard has about ``passages_per_shard`` passages; routes
    of more of them are compared by windows. Anchors of more than ``common_docs``
    documents spread by single windows, each a route of its own.
    """
    slim = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("doc_id"),
        row_hash(F.col(text_col)).alias("row"),
        F.col(text_col).alias("text"),
    )
    # Tables of a scratch store go as soon as the next one is written.
    with type(store)(store.spark, store.root) as scratch:
        grams = scratch.keep(anchor_rows(slim.select("doc_id", "row", "text"), window, anchor), "anchors")
        shared = scratch.keep(
            grams.groupBy("gram")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .select("gram", (F.col("n") > common_docs).alias("common")),
            "shared_anchors",
        )
        hits = (
            grams.join(shared.hint("shuffle_hash"), "gram")
            .groupBy("doc_id", "row")
            .agg(F.collect_set(F.struct("gram", "common")).alias("grams"))
        )
        found = store.keep(
            passages(slim.join(hits, ["doc_id", "row"]).select("doc_id", "row", "text", "grams"), window, anchor),
            "passages",
        )
    with type(store)(store.spark, store.root) as scratch:
        distinct = scratch.keep(
            found.groupBy("route", "p1", "p2", "n", "passage").agg(F.min("doc_id").alias("doc_id")), "distinct"
        )
        own = ("p1", "p2", "n", "doc_id")
        routes = scratch.keep(
            distinct.groupBy("route").agg(F.count(F.lit(1)).alias("k"), *(F.first(c).alias(c) for c in own)), "routes"
        )
        # One passage: its windows occur nowhere else.
        whole = F.struct(F.lit(0).alias("at"), F.col("n").cast("int").alias("n"), F.col("doc_id").alias("least"))
        alone = routes.where("k = 1").select("p1", "p2", F.array(whole).alias("runs"))
        in_shards = F.col("k") <= passages_per_shard
        sizes = routes.where("k > 1").agg(
            F.sum(F.when(in_shards, F.col("k"))).alias("sharded"),
            F.sum(F.when(~in_shards, F.col("k"))).alias("crowded"),
        ).first()
        several = distinct.join(routes.where("k > 1").select("route", "k").hint("shuffle_hash"), "route")
        answers = [alone]
        if sizes["sharded"]:
            shards = math.ceil(sizes["sharded"] / passages_per_shard)
            sharded = several.where(in_shards).withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
            answers.append(earliest(sharded.select("shard", "p1", "p2", "doc_id", "passage"), window))
        if sizes["crowded"]:
            answers.append(earliest_by_window(several.where(~in_shards), window))
        least = store.keep(reduce(DataFrame.unionByName, answers), "least")
    flagged = (
        found.select("doc_id", "row", "start", "p1", "p2")
        .join(least, ["p1", "p2"])
        .select("doc_id", "row", "start", F.inline("runs"))
        .where("least < doc_id")
    )
    # A set, as above: equal rows find the same, and each of them is joined with it.
    first = (F.col("start") + F.col("at")).alias("first")
    return flagged.groupBy("doc_id", "row").agg(F.collect_set(F.struct(first, "n")).alias("runs"))


def cut(
    docs: DataFrame, repeated: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every row of ``docs``.

    ``spans`` are the maximal runs [first, end) of removed words; ``kept`` are the
    other words with one space between. Null, empty and blank texts have no words.
    """
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("given_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("doc_id"),
        row_hash(F.col(text_col)).alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    joined = slim.join(repeated, ["doc_id", "row"], "left").select("given_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(2)
            run_bounds, fields = runs.offsets.to_numpy(), runs.values.flatten()
            run_first, run_n = (f.to_numpy() for f in fields)
            for start, end, data, offsets in text_slices(batch.column(1), PART_BYTES):
                starts, ends = word_bounds(data, offsets)
                bounds = np.searchsorted(starts, offsets)
                low, high = run_bounds[start], run_bounds[end]
                first = run_first[low:high] + np.repeat(bounds[:-1], np.diff(run_bounds[start : end + 1]))
                gone = np.zeros(len(starts) + 1, np.int64)
                np.add.at(gone, first, 1)
                np.add.at(gone, first + run_n[low:high] + (window - 1), -1)
                covered = np.cumsum(gone)[:-1] > 0
                texts = np.searchsorted(offsets, starts, side="right") - 1
                # Spans: runs of covered words, cut where a text ends.
                same = covered[1:] & covered[:-1] & (texts[1:] == texts[:-1])
                opens = np.flatnonzero(covered & ~np.append(False, same))
                closes = np.flatnonzero(covered & ~np.append(same, False)) + 1
                base = bounds[texts[opens]]
                spans = pa.StructArray.from_arrays(
                    [pa.array((opens - base).astype(np.int32)), pa.array((closes - base).astype(np.int32))],
                    names=["first", "end"],
                )
                # Kept bytes: the other words, and the space after each but the last one of its text.
                words = np.flatnonzero(~covered)
                change = np.zeros(len(data) + 1, np.int8)
                change[starts[words]] = 1
                change[ends[words]] -= 1
                kept = np.cumsum(change[:-1], dtype=np.int8).view(bool)
                inner = ends[words[:-1][texts[words[1:]] == texts[words[:-1]]]]
                plain = data.copy()
                plain[inner] = 0x20
                kept[inner] = True
                place = np.zeros(len(data) + 1, np.int64)
                np.cumsum(kept, out=place[1:])
                removed = np.append(0, np.cumsum(covered))[bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(np.diff(bounds)),
                        pa.array(np.diff(removed)),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(opens, bounds).astype(np.int32)), spans),
                        pa.StringArray.from_buffers(
                            end - start, pa.py_buffer(place[offsets].astype(np.int32)), pa.py_buffer(plain[kept])
                        ),
                    ],
                    names=["doc_id", "n_words", "n_removed", "spans", "kept"],
                )

    return joined.mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_removed bigint,"
        " spans array<struct<first: int, end: int>>, kept string",
    )


def remove_repeats(docs: DataFrame, store: StageStore, window: int = WINDOW, **options) -> DataFrame:
    """Every row without the words of windows that a document with a smaller id holds.

    Windows of ``window`` words are judged on the input. A null id comes before
    all others. Equal rows and rows of one id are not earlier than each
    other. Texts of fewer words stay whole; an empty table gives no rows.
    """
    return cut(docs, repeated_windows(docs, store, window, **options), window)
