"""Near-duplicate documents by MinHash with fast similarity sketching.

A sketch has t coordinates. In round r every shingle falls into the bin its
r-th hash names; from round t on, all shingles compete for bin r - t, so after at
most 2 t rounds every coordinate is filled. A bin belongs to the first
round that reaches it and keeps the smallest hash of that round. Runs of
coordinates form bands; documents that share a band are compared on their full
shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.components import connected_components
from fairlead.llm.token_arrays import distinct_shingles, mix, split_words, text_slices
from fairlead.sources.stages import StageStore

WIDTH = 5
BANDS = 40
ROWS = 5
PERCENT = 75
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = np.uint64(0x9E3779B97F4A7C15)


def step(k: int) -> np.uint64:
    """``k`` times the step, modulo 2**64."""
    return np.uint64(int(STEP) * k & 0xFFFFFFFFFFFFFFFF)


def sketches(hashes: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """Sketch of each text's distinct hashes; rows of texts without any stay NONE."""
    n = len(bounds) - 1
    out = np.full((n, t), NONE)
    sizes = np.diff(bounds)
    live = np.flatnonzero(sizes > 0)  # texts with open bins
    place = np.repeat(np.arange(n), sizes)
    for r in range(2 * t):
        if not len(live):
            break
        index = np.full(n, -1)
        index[live] = np.arange(len(live))
        if (index[place] < 0).any():
            keep = index[place] >= 0
            hashes, place = hashes[keep], place[keep]
        drawn = mix(hashes + step(r + 1))
        if r < t:
            spots = ((drawn >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            spots = np.full(len(drawn), r - t)
        reached = np.full(len(live) * t, NONE)
        np.minimum.at(reached, index[place] * t + spots, mix(drawn))
        reached = reached.reshape(len(live), t)
        mine = out[live]
        mine = np.where(mine == NONE, reached, mine)
        out[live] = mine
        live = live[(mine == NONE).any(axis=1)]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(sketch), bands), np.uint64)
    for k in range(rows):
        keys = mix(keys + sketch[:, k::rows][:, :bands] + step(k + 1))
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64))


def sketch_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """(doc_id, given_id, n_shingles, set_1, set_2, bands) of (doc_id, text, given_id) rows.

    The two set hashes are equal for equal shingle sets.
    """
    t = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1)):
                hashes, bounds = distinct_shingles(split_words(data, offsets, lower=True), width)
                keys = band_keys(sketches(hashes, bounds, t), bands, rows)
                sums = []
                for salt in (np.uint64(1), np.uint64(2)):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes * STEP + salt))])
                    sums.append(pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)))
                flat = pa.array(np.ascontiguousarray(keys).view(np.int64).ravel())
                where = pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        batch.column(2).slice(start, end - start),
                        pa.array(np.diff(bounds), pa.int64()),
                        *sums,
                        pa.ListArray.from_arrays(where, flat),
                    ],
                    names=["doc_id", "given_id", "n_shingles", "set_1", "set_2", "bands"],
                )

    return docs.mapInArrow(
        run,
        "doc_id bigint, given_id bigint, n_shingles bigint, set_1 bigint, set_2 bigint, bands array<bigint>",
    )


def verified(pairs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The (a, b) of (a, b, text_a, text_b) whose full shingle sets are similar enough.

    100 * common >= percent * all. Sets of the texts seen last are remembered,
    which serves rows sorted by one side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=32)
        def shingle_set(text: str) -> np.ndarray:
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            return distinct_shingles(split_words(raw, np.array([0, len(raw)]), lower=True), width)[0]

        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                one, two = shingle_set(x.as_py()), shingle_set(y.as_py())
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked[i] = 100 * common >= percent * (len(one) + len(two) - common)
            yield batch.select([0, 1]).filter(pa.array(linked))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def exploded_shingles(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingle) for the distinct shingles of (doc_id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1)):
                hashes, bounds = distinct_shingles(split_words(data, offsets, lower=True), width)
                where = pa.array(np.repeat(np.arange(end - start), np.diff(bounds)))
                ids = batch.column(0).slice(start, end - start).take(where)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(hashes.view(np.int64))], names=["doc_id", "shingle"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, shingle bigint")


def bucket_leaders(members: DataFrame, by: str, store: StageStore) -> DataFrame:
    """(key, leader, leader_component, rank): the member of each bucket with most of ``by``."""
    top = F.max(F.struct(by, "rep", "component"))
    found = members.groupBy("key").agg(top.alias("top"))
    leaders = found.select(
        "key", F.col("top.rep").alias("leader"), F.col("top.component").alias("leader_component"), F.col(f"top.{by}").alias("rank")
    )
    return store.keep(leaders, "leaders")


def as_pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def one_pair_each(members: DataFrame, by: str, store: StageStore) -> DataFrame:
    """Distinct pairs (a, b), a < b, of each member and the foremost of the leaders of its buckets."""
    met = members.join(bucket_leaders(members, by, store), "key").where("rep <> leader")
    chosen = met.groupBy("rep").agg(F.max(F.struct("rank", "leader"))["leader"].alias("leader"))
    return chosen.select(*as_pair("rep", "leader")).distinct()


def star_pairs(members: DataFrame, by: str, store: StageStore) -> DataFrame:
    """Distinct pairs (a, b), a < b, of each member and the leaders of its buckets in other components."""
    met = members.join(bucket_leaders(members, by, store), "key").where("component <> leader_component")
    return met.select(*as_pair("rep", "leader")).distinct()


def undecided(members: DataFrame) -> DataFrame:
    """The (key, rep, component, ...) of buckets with more than one component."""
    split = (
        members.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key")
    )
    return members.join(split, "key")


def different_buckets(open_: DataFrame, store: StageStore) -> DataFrame:
    """``open_`` with one bucket of those that hold the same members."""
    members = open_.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("rep")).alias("one"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("two"),
    )
    kept = members.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key")
    return store.keep(open_.join(kept, "key"), "different_buckets")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(rep, shingles): the distinct shingles of (doc_id, text) rows as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1)):
                hashes, bounds = distinct_shingles(split_words(data, offsets, lower=True), width)
                sets = [hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(sets, pa.binary())], names=["rep", "shingles"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "rep bigint, shingles binary")


def member_blocks(
    open_: DataFrame, texts: DataFrame, store: StageStore, width: int, rows_per_block: int, bytes_per_block: int
) -> DataFrame:
    """(key, blocks, block, and :class:`Block`): the members of every bucket in blocks of bounded rows and bytes."""
    keys = open_.groupBy("rep").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    wanted = texts.join(keys.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    known = store.keep(keys.join(shingle_sets(wanted, width), "rep"), "open_members")
    member = open_.select("key", "rep", "component").join(
        known.select("rep", F.octet_length("shingles").alias("size")), "rep"
    )
    blocks = member.groupBy("key").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / rows_per_block), F.ceil(F.sum("size") / bytes_per_block)
        ).alias("blocks")
    )
    blocks = store.keep(blocks, "bucket_blocks")
    dealt = member.join(blocks, "key").select(
        "key", "blocks", "rep", "component", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block")
    )
    whole = dealt.join(known, "rep")
    gathered = whole.groupBy("key", "blocks", "block").agg(
        F.collect_list(F.struct("rep", "component", "keys", "shingles")).alias("members")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *place, members in zip(*(batch.column(k) for k in range(4)), strict=True):
                arrays = Block.of(members.as_py()).arrays()
                columns = [pa.array([x.as_py()], pa.int64()) for x in place]
                columns += [pa.array([a.tobytes()], pa.binary()) for a in arrays]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "blocks", "block", *Block.KINDS])

    kinds = ", ".join(f"{name} binary" for name in Block.KINDS)
    return store.keep(gathered.mapInArrow(pack, f"key bigint, blocks bigint, block bigint, {kinds}"), "member_blocks")


def links_between(
    open_: DataFrame,
    texts: DataFrame,
    store: StageStore,
    percent: int,
    width: int,
    rows_per_block: int = 64,
    bytes_per_block: int = 1 << 21,
    blocks_per_group: int = 8,
) -> DataFrame:
    """Links (a, b) between members of different components that still share a bucket.

    ``open_`` has (key, rep, component). The members of a bucket are cut into blocks
    and every block meets every other of its bucket; about ``rows_per_block`` ** 2
    pairs are compared at once and only links are written. A pair is compared in
    the first bucket that it shares.
    """
    open_ = different_buckets(open_, store)
    blocks = member_blocks(open_, texts, store, width, rows_per_block, bytes_per_block)
    # Blocks go in groups, every group of a bucket to a cell with every other:
    # cells are bounded and no bucket is hot.
    mine = F.floor(F.col("block") / blocks_per_group)
    groups = F.ceil(F.col("blocks") / blocks_per_group)
    dealt = blocks.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), groups - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    cell = F.concat_ws(":", *(c.cast("string") for c in (F.col("key"), low, high))).alias("cell")
    half = F.when(F.col("mine") == F.col("other"), -1).when(F.col("mine") < F.col("other"), 0).otherwise(1)

    def links_of(key: int, members: list[tuple[int, Block]]) -> pa.RecordBatch:
        pairs = []
        for i, (side, one) in enumerate(members):
            for other_side, two in members[i:]:
                if side == -1 or side != other_side:
                    pairs += block_links(key, one, two, percent)
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key, held = None, None, []
        for batch in batches:
            for row in range(batch.num_rows):
                at = batch.column(0)[row].as_py()
                if at != current:
                    if held:
                        yield links_of(key, held)
                    current, key, held = at, batch.column(1)[row].as_py(), []
                parts = [batch.column(3 + k)[row].as_buffer() for k in range(len(Block.KINDS))]
                held.append((batch.column(2)[row].as_py(), Block.read(parts)))
        if held:
            yield links_of(key, held)

    cells = dealt.select(cell, "key", half.cast("int").alias("half"), *Block.KINDS)
    ordered = cells.repartition("cell").sortWithinPartitions("cell")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def block_links(key: int, one: Block, two: Block, percent: int) -> list[list[int]]:
    """Links between the members of two blocks of the bucket ``key``."""
    wanted = one.components[:, None] != two.components[None, :]
    # A pair that shares an earlier bucket is compared there.
    wanted &= ~(products(one.earlier(key), two.earlier(key)) > 0)
    if not wanted.any():
        return []
    common = products(*(Incidence(b.shingles, b.shingle_rows, len(b.reps)) for b in (one, two)))
    union = one.sizes[:, None] + two.sizes[None, :] - common
    linked = wanted & (common > 0) & (100 * common >= percent * union)
    return [sorted((int(one.reps[i]), int(two.reps[j]))) for i, j in zip(*np.nonzero(linked), strict=True)]


@dataclass
class Incidence:
    """Values that rows hold."""

    values: np.ndarray
    rows: np.ndarray
    n: int


def products(one: Incidence, two: Incidence) -> np.ndarray:
    """Number of common values of each row of one and each row of the other."""
    shared = np.intersect1d(one.values, two.values)
    tables = []
    for side in (one, two):
        table = np.zeros((side.n, len(shared)), np.float32)
        if len(shared):
            at = np.minimum(np.searchsorted(shared, side.values), len(shared) - 1)
            held = shared[at] == side.values
            table[side.rows[held], at[held]] = 1
        tables.append(table)
    return (tables[0] @ tables[1].T).astype(np.int64)


@dataclass
class Block:
    """Members of a bucket as arrays: ids, components, open buckets and distinct shingles of each."""

    KINDS: ClassVar[dict[str, str]] = {
        "reps": "<i8", "components": "<i8", "keys": "<i8", "key_counts": "<i8", "shingles": "<u8", "sizes": "<i8",
    }

    reps: np.ndarray
    components: np.ndarray
    keys: np.ndarray
    key_counts: np.ndarray
    shingles: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, members: list[dict]) -> Block:
        """From members (rep, component, keys, shingles as bytes)."""
        sets = [np.frombuffer(m["shingles"], "<u8") for m in members]
        return cls(
            np.array([m["rep"] for m in members], "<i8"),
            np.array([m["component"] for m in members], "<i8"),
            np.array([k for m in members for k in m["keys"]], "<i8"),
            np.array([len(m["keys"]) for m in members], "<i8"),
            np.concatenate(sets),
            np.array([len(x) for x in sets], "<i8"),
        )

    @classmethod
    def read(cls, buffers: list) -> Block:
        return cls(*(np.frombuffer(b, kind) for b, kind in zip(buffers, cls.KINDS.values(), strict=True)))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.KINDS]

    @property
    def shingle_rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def earlier(self, key: int) -> Incidence:
        """The open buckets before ``key`` of each member."""
        rows = np.repeat(np.arange(len(self.key_counts)), self.key_counts)
        before = self.keys < key
        return Incidence(self.keys[before], rows[before], len(self.reps))


def near_duplicates(
    docs: DataFrame,
    store: StageStore,
    bands: int = BANDS,
    rows: int = ROWS,
    percent: int = PERCENT,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents whose sets of ``width``-word shingles (A-Z folded; fewer words are
    one shingle) share ``percent`` of their union are linked; a component is
    named after its smallest id and keeps that document. Two documents just at
    the threshold meet in a band with probability 1 - (1 - 0.75**5)**40, over
    0.99997, and every link is confirmed on full sets.

    Documents of equal sets form one class and its smallest id stands for it.
    Every member is first compared with one member of its buckets, the one that
    shares most buckets with others; then with the foremost of each bucket
    that still holds another component. Members still apart are counted out
    where an exact bound rules a link out, and compared with the one that
    differs least from others; components still apart are compared member by
    member, in blocks. So no link inside a bucket is missed, while a large
    group of copies costs a comparison or two per member.

    Null and empty texts and texts without words have no shingles and stand
    alone. Rows of one id count as one document. Rows with a null id are documents
    by their text; they keep the null id, and a component is named after one
    only if it holds no other. An empty table gives no rows.
    """
    return judged_documents(docs, store, bands, rows, percent, width, id_col, text_col).select(
        F.col("given_id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


def document_number(id_col: str, text_col: str) -> Column:
    """The id, or for a null id a number made from the text."""
    made = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseOR(F.lit(-(1 << 63)))
    return F.coalesce(F.col(id_col).cast("bigint"), made)


def judged_documents(
    docs: DataFrame, store: StageStore, bands: int, rows: int, percent: int, width: int, id_col: str, text_col: str
) -> DataFrame:
    """:func:`near_duplicates` with ``number``, which also tells null ids apart, and ``given_id``."""
    slim = docs.select(
        document_number(id_col, text_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(id_col).cast("bigint").alias("given_id"),
    )
    sketched = store.keep(sketch_documents(slim, bands, rows, width), "sketches")
    full = sketched.where("n_shingles > 0")
    alike = ["n_shingles", "set_1", "set_2"]
    classes = store.keep(
        full.groupBy(*alike).agg(F.min("doc_id").alias("rep"), F.min("given_id").alias("least")), "classes"
    )
    # One row per class: that of the smallest id.
    reps = (
        full.join(classes.select(*alike, "rep", F.col("rep").alias("doc_id")), [*alike, "doc_id"])
        .select("rep", F.explode("bands").alias("key"))
    )
    # Written tables on one side of a join by bucket let Spark split a hot bucket.
    sizes = store.keep(
        reps.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes"
    )
    buckets = store.keep(reps.join(sizes, "key"), "buckets")
    central = buckets.groupBy("rep").agg(F.sum("size").alias("ties"))
    tied = store.keep(
        buckets.drop("size").join(central, "rep").withColumn("component", F.col("rep")), "tied"
    )
    first_pairs = store.keep(one_pair_each(tied, "ties", store), "first_pairs")
    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
    texts = store.keep(slim.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        text = {side: texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab"}
        joined = pairs.join(text["b"], "b").join(text["a"], "a")
        return verified(joined.select("a", "b", "text_a", "text_b"), percent, width)

    def grown(components: DataFrame | None, found: DataFrame) -> DataFrame:
        """Components with more links; earlier ones go on as one edge per member."""
        if components is not None:
            if found.isEmpty():
                return components
            edges = components.where("vertex <> component")
            found = found.unionByName(edges.select(F.col("vertex").alias("a"), F.col("component").alias("b")))
        return connected_components(found, store)

    def renamed(members: DataFrame, components: DataFrame) -> DataFrame:
        """Members of buckets that hold several of these components, with theirs."""
        names = components.select(F.col("vertex").alias("rep"), F.col("component").alias("named"))
        found = members.drop("component").join(names, "rep", "left")
        return undecided(found.withColumn("component", F.coalesce("named", "rep")).drop("named"))

    components = grown(None, store.keep(confirmed(first_pairs), "first_links"))
    apart = store.keep(renamed(tied, components).select("key", "rep", "component"), "apart")
    loose = texts.join(apart.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # A shingle of one document alone is common to no pair, so a set of n shows
    # at most n - alone of them to a partner and has at least its own n, or the
    # partner's and what is alone, in the union.
    alone = (
        exploded_shingles(loose, width)
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("holders"), F.min("doc_id").alias("rep"))
        .where("holders = 1")
        .groupBy("rep")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    known = store.keep(
        apart.join(classes.select("rep", F.col("n_shingles").alias("n")), "rep")
        .join(alone, "rep", "left")
        .withColumn("alone", F.coalesce("alone", F.lit(0))),
        "apart_sizes",
    )
    smallest = known.groupBy("key").agg(F.min("n").alias("smallest"))
    least_union = F.greatest("n", F.col("smallest") + F.col("alone"))
    able = known.join(smallest, "key").where(
        100 * (F.col("n") - F.col("alone")) >= percent * least_union
    )
    able = store.keep(undecided(able.drop("smallest")), "able")
    # Once more with the member that differs least from what others hold.
    closest = able.withColumn("shared", -F.col("alone"))
    second = store.keep(
        star_pairs(closest, "shared", store).join(first_pairs, ["a", "b"], "left_anti"), "second_stars"
    )
    components = grown(components, store.keep(confirmed(second), "second_links"))
    open_ = store.keep(renamed(able, components).select("key", "rep", "component"), "open")
    more = store.keep(links_between(open_, texts, store, percent, width), "more_links")
    components = grown(components, more)
    named = classes.join(components, F.col("rep") == F.col("vertex"), "left").select(
        *alike, "rep", "least", F.coalesce("component", "rep").alias("component")
    )
    # The least of the given ids names a component, and the least number where all are null.
    names = named.groupBy("component").agg(F.min("least").alias("component_id"), F.min("rep").alias("least_number"))
    labels = named.join(names, "component").select(
        *alike, "component_id", F.coalesce("component_id", "least_number").alias("head")
    )
    placed = sketched.join(labels, alike, "left")
    return placed.select(
        F.col("doc_id").alias("number"),
        "given_id",
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("given_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("doc_id") == F.coalesce("head", "doc_id")).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, store: StageStore, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row of each document of ``docs`` that :func:`near_duplicates` keeps, with all its columns.

    Rows of one kept id stay if their texts differ; of equal ones the first in
    the order of all columns stays. Null ids never displace another id.
    """
    settings = {"bands": BANDS, "rows": ROWS, "percent": PERCENT, "width": WIDTH} | options
    judged = judged_documents(docs, store, **settings, id_col=id_col, text_col=text_col)
    per_number = judged.groupBy("number").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = store.keep(per_number.where("NOT kept OR n > 1"), "gone_or_repeated")
    row = F.struct(*(F.col(c) for c in docs.columns))
    numbered = docs.select(document_number(id_col, text_col).alias("number"), row.alias("row"))
    once = numbered.join(odd.select("number"), "number", "left_anti").select("row")
    # Only ids that occur more than once are shuffled whole.
    again = numbered.join(odd.where("kept").select("number"), "number", "left_semi")
    text = F.col("row")[text_col]
    folded = again.groupBy("number", F.xxhash64(text), text.isNull()).agg(F.min("row").alias("row"))
    return once.unionByName(folded.select("row")).select("row.*")
