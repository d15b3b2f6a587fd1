"""Near-duplicates among embedding vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Every
pivot has an inverted list of the vectors that name it; two vectors of a list
that share enough pivots are candidates, and candidates are verified by their
exact cosine.

Copies are folded before the search, so a group of any size stays cheap: equal
vectors are one class, and classes within half the linking angle of a common
leader are one unit, all linked with one another. Two units are compared by
their leaders; only where the radii leave it open are their members compared.
Links are counted and spanning edges kept, pairs of vectors are never written:
what is written grows with the members and the open pairs of units.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.components import connected_components
from fairlead.sources.stages import StageStore

THRESHOLD = 0.93
#: Pivots that describe a vector, and how many of them two candidates share.
NEAREST, SHARED = 8, 2
#: Leaders that are offered to the classes of one cell.
LEADERS = 8
#: Units of a list (members of a unit) that are compared at once.
BLOCK = 512
#: Pivots: one for so many classes, at least and at most so many.
CLASSES_PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 512, 64, 4096
#: Classes read to the driver for each pivot that is chosen among them.
SAMPLE_PER_PIVOT = 2
#: Cosine from which two sampled vectors are too close to be both pivots.
PIVOT_COSINE = 0.7
#: Keeps decisions by angles clear of rounding; the rest is decided by the cosine.
MARGIN = 1e-6


# --- Vectors, classes, pivots -----------------------------------------------


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link: labelled, every component finite, one not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def keyed_vectors(rows: DataFrame, store: StageStore, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, group, key, v): ``key`` tells classes apart and is null for vectors that cannot link.

    ``group`` holds what has to be equal: dimension and label.
    """
    slim = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        # Adding zero turns -0.0 into 0.0.
        F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"),
        F.col(label_col).alias("label"),
    )
    group = F.concat(F.size("v").cast("string"), F.lit(":"), F.col("label").cast("string"))
    digest = F.sha2(F.concat_ws("|", F.col("v").cast("array<string>"), group).cast("binary"), 256)
    marked = slim.select(
        "vec_id", "v", F.when(usable(F.col("v"), F.col("label")), group).alias("group"),
        F.when(usable(F.col("v"), F.col("label")), digest).alias("key"),
    )
    return store.keep(marked, "vectors")


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, n: int, dim: int) -> np.ndarray:
    """``n`` reference points: sampled vectors not too close to one another, then random directions."""
    chosen = np.zeros((0, dim))
    for row in sample:
        if len(chosen) == n:
            break
        if not len(chosen) or (chosen @ row).max() < PIVOT_COSINE:
            chosen = np.vstack([chosen, row])
    drawn = np.random.default_rng(dim).normal(size=(n - len(chosen), dim))
    return np.vstack([chosen, units_of(drawn)]) if len(drawn) else chosen


def as_binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, "<f8")], pa.binary())


def lists_of(column: pa.Array) -> np.ndarray:
    """Equally long lists of doubles as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def by_dimension(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[tuple[int, pa.RecordBatch]]:
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def described(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """(cid, group, n, least, u, tops): unit vector and ordered nearest pivots of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = pc.list_value_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dim, batch in by_dimension(whole, sizes):
                u = units_of(lists_of(batch.column("v")))
                points = pivots.get(dim)
                if points is None:  # a dimension without a sampled class
                    points = choose_pivots(np.zeros((0, dim)), LEAST_PIVOTS, dim)
                k = min(nearest, len(points))
                tops = np.argsort(-(u @ points.T), axis=1, kind="stable")[:, :k].astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, k * len(u) + 1, k, dtype=np.int32), tops.ravel())
                columns = [batch.column(c) for c in ("cid", "group", "n", "least")]
                yield pa.RecordBatch.from_arrays([*columns, as_binary(u), lists], ["cid", "group", "n", "least", "u", "tops"])

    return classes.select("cid", "group", "n", "least", "v").mapInArrow(
        run, "cid bigint, group string, n bigint, least bigint, u binary, tops array<int>"
    )


# --- Units ------------------------------------------------------------------


def leaders_of(classes: DataFrame, store: StageStore) -> DataFrame:
    """(cell, leaders): a few classes of each cell, the same whatever the layout.

    A cell holds the classes of one group and nearest pivot. Where copies make
    up a good part of a cell, one of the leaders is among them.
    """
    picks = [F.min(F.struct(F.xxhash64("cid", F.lit(j)), "cid", "u")).alias(f"leader_{j}") for j in range(LEADERS)]
    found = classes.groupBy("group", F.get("tops", F.lit(0)).alias("cell")).agg(*picks)
    leaders = F.array(*(F.struct(f"leader_{j}.cid", f"leader_{j}.u") for j in range(LEADERS)))
    return store.keep(found.select("group", "cell", leaders.alias("leaders")), "leaders")


def with_units(classes: DataFrame, leaders: DataFrame, threshold: float) -> DataFrame:
    """Adds ``unit``, ``centre`` and ``angle``: the first leader within half the linking angle, or the class."""
    reach = math.acos(threshold) / 2 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, centre, angle = [], [], []
            rows = zip(batch.column("cid").to_pylist(), batch.column("u").to_pylist(), batch.column("leaders").to_pylist(), strict=True)
            for cid, u, offered in rows:
                own = np.frombuffer(u, "<f8")
                points = np.frombuffer(b"".join(o["u"] for o in offered), "<f8").reshape(len(offered), -1)
                angles = np.arccos(np.clip(points @ own, -1, 1))
                near = np.flatnonzero(angles <= reach)
                first = near[0] if len(near) else None
                unit.append(cid if first is None else offered[first]["cid"])
                centre.append(u if first is None else offered[first]["u"])
                angle.append(0.0 if unit[-1] == cid else float(angles[first]))
            kept = [batch.column(c) for c in ("cid", "group", "n", "least", "u", "tops")]
            made = [pa.array(unit, pa.int64()), pa.array(centre, pa.binary()), pa.array(angle, pa.float64())]
            names = ["cid", "group", "n", "least", "u", "tops", "unit", "centre", "angle"]
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    celled = classes.withColumn("cell", F.get("tops", F.lit(0))).join(leaders, ["group", "cell"]).drop("cell")
    return celled.mapInArrow(
        run,
        "cid bigint, group string, n bigint, least bigint, u binary, tops array<int>,"
        " unit bigint, centre binary, angle double",
    )


def summarised(members: DataFrame) -> DataFrame:
    """(unit, group, size, least, radius, centre, tops): one row per unit, ``tops`` of all members."""
    bodies = members.groupBy("unit").agg(
        F.min("group").alias("group"),
        F.sum("n").alias("size"),
        F.min("least").alias("least"),
        F.max("angle").alias("radius"),
        F.min("centre").alias("centre"),
    )
    # At most one entry per pivot, whatever the number of members.
    named = members.select("unit", F.explode("tops").alias("pivot")).distinct()
    pivots = named.groupBy("unit").agg(F.sort_array(F.collect_list("pivot")).alias("tops"))
    return bodies.join(pivots, "unit")


# --- Comparison in blocks ---------------------------------------------------


def dealt(rows: DataFrame, keys: list[str], item: Column, block: int, store: StageStore) -> DataFrame:
    """Rows of each key in blocks of about ``block``, one copy for each pair of blocks.

    Adds ``cell`` (key and pair of blocks) and ``half`` (0 or 1: of the pair's
    first or second block; -1: both are the same).
    """
    counts = rows.groupBy(*keys).count().select(*keys, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    counts = store.keep(counts, "block_counts")
    mine = rows.join(counts, keys).withColumn("mine", F.pmod(F.xxhash64(item), F.col("blocks")).cast("int"))
    paired = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    half = F.when(F.col("mine") == F.col("other"), -1).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    cell = F.concat_ws(":", *(F.col(c).cast("string") for c in keys), low.cast("string"), high.cast("string"))
    return paired.withColumns({"cell": cell, "half": half}).drop("blocks", "mine", "other")


def grouped(batches: Iterator[pa.RecordBatch], column: str = "cell") -> Iterator[pa.Table]:
    """Consecutive rows of equal ``column``, whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        changes = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(values)]
        for start, end in zip(cuts, cuts[1:]):
            part = batch.slice(start, end - start)
            if held and held[0].column(column)[0] != part.column(column)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix of links."""
    edges = []
    open_ = np.ones(len(linked), bool)
    for root in np.flatnonzero(linked.any(axis=1)):
        if not open_[root]:
            continue
        open_[root] = False
        stack = [root]
        while stack:
            at = stack.pop()
            found = np.flatnonzero(linked[at] & open_)
            open_[found] = False
            edges += [(at, other) for other in found.tolist()]
            stack += found.tolist()
    return edges


OUTCOME = "kind string, a bigint, b bigint, n bigint"


def outcome(links: list[tuple], edges: list[tuple], unsure: list[tuple]) -> pa.RecordBatch:
    """Links added to a, edges between a and b, pairs (a, b) that their members decide."""
    rows = [("links", a, None, n) for a, n in links]
    rows += [("edge", a, b, None) for a, b in edges]
    rows += [("unsure", a, b, None) for a, b in unsure]
    kinds, a, b, n = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), *(pa.array(x, pa.int64()) for x in (a, b, n))], ["kind", "a", "b", "n"]
    )


def pairs_wanted(half: np.ndarray) -> np.ndarray:
    """Pairs to compare in a cell: all of one block, or those across two."""
    n = len(half)
    wanted = ~np.eye(n, dtype=bool)
    if (half >= 0).any():
        wanted = half[:, None] != half[None, :]
    return wanted


def compare_units(threshold: float, shared: int) -> Callable:
    """Candidates of each list and their links, by the angles of centres and the radii."""
    angle_limit = math.acos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            unit = table["unit"].to_numpy()
            if len(unit) < 2:
                continue
            size, radius, pivot = table["size"].to_numpy(), table["radius"].to_numpy(), table["pivot"][0].as_py()
            centres = table["centre"].to_pylist()
            u = np.frombuffer(b"".join(centres), "<f8").reshape(len(centres), -1)
            tops = table["tops"].combine_chunks()
            named, place = np.unique(tops.flatten().to_numpy(), return_inverse=True)
            has = np.zeros((len(unit), len(named)), np.float32)
            has[np.repeat(np.arange(len(unit)), pc.list_value_length(tops).to_numpy()), place] = 1
            earlier = has[:, named < pivot]
            # A pair is compared in the list of the first pivot that it shares.
            candidate = pairs_wanted(table["half"].to_numpy()) & (has @ has.T >= shared) & (earlier @ earlier.T == 0)
            if not candidate.any():
                continue
            cosine = u @ u.T
            angle = np.arccos(np.clip(cosine, -1, 1))
            spread = radius[:, None] + radius[None, :]
            exact = spread == 0
            linked = candidate & np.where(exact, cosine >= threshold, angle + spread <= angle_limit - MARGIN)
            unsure = candidate & ~exact & ~linked & (angle - spread <= angle_limit + MARGIN)
            added = linked @ size
            yield outcome(
                [(unit[i].item(), added[i].item()) for i in np.flatnonzero(added)],
                [(unit[i].item(), unit[j].item()) for i, j in spanning(linked)],
                [(unit[i].item(), unit[j].item()) for i, j in zip(*np.nonzero(np.triu(unsure)), strict=True)],
            )

    return run


def compare_members(threshold: float) -> Callable:
    """Exact links between the members of two units, per pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            first = table["first"].to_numpy(zero_copy_only=False).astype(bool)
            if first.all() or not first.any():
                continue
            cid, n = table["cid"].to_numpy(), table["n"].to_numpy()
            vectors = table["u"].to_pylist()
            u = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
            linked = u[first] @ u[~first].T >= threshold
            if not linked.any():
                continue
            links = [(c, k) for c, k in zip(cid[first].tolist(), (linked @ n[~first]).tolist(), strict=True) if k]
            links += [(c, k) for c, k in zip(cid[~first].tolist(), (n[first] @ linked).tolist(), strict=True) if k]
            # The members of a unit are linked already: one edge joins two units.
            yield outcome(links, [(table["a"][0].as_py(), table["b"][0].as_py())], [])

    return run


def members_dealt(unsure: DataFrame, members: DataFrame, block: int, store: StageStore) -> DataFrame:
    """Members of the units of each open pair, every block of one with every block of the other."""
    counts = members.groupBy("unit").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    counts = store.keep(counts, "unit_blocks")
    sized = unsure.join(counts.select(F.col("unit").alias("a"), F.col("blocks").alias("blocks_a")), "a").join(
        counts.select(F.col("unit").alias("b"), F.col("blocks").alias("blocks_b")), "b"
    )
    sized = store.keep(sized, "unsure")
    slim = members.select("unit", "cid", "n", "u")

    def side(unit: str, own: str, other: str, first: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("cid"), F.col(own)).cast("int")
        met = (
            slim.join(sized.withColumnRenamed(unit, "unit"), "unit")
            .withColumnRenamed("unit", unit)
            .withColumn("mine", mine)
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        )
        pair = ("mine", "theirs") if first else ("theirs", "mine")
        cell = F.concat_ws(":", *(F.col(c).cast("string") for c in ("a", "b", *pair)))
        return met.select("a", "b", "cid", "n", "u", F.lit(first).alias("first"), cell.alias("cell"))

    return side("a", "blocks_a", "blocks_b", True).unionByName(side("b", "blocks_b", "blocks_a", False))


# --- The whole --------------------------------------------------------------


def near_duplicate_vectors(
    rows: DataFrame,
    store: StageStore,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
    most_pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Two vectors link if their labels are equal and not null, their dimensions are
    equal and their cosine is at least ``threshold``. Vectors that are null, zero
    or hold null or non-finite components link with nothing. ``n_links`` counts
    other rows linked directly, ``component_id`` is the smallest id reachable by
    links, ``kept`` says whether that is the row's own.

    The index is approximate: vectors that share fewer than ``shared`` of their
    ``nearest`` pivots are not compared (of random pairs exactly at 0.93, fewer
    than 2 % with up to 1,024 pivots). Links are exact: none lies below the threshold,
    and equal vectors always link. Every row is indexed; only the pivots come
    from a sample, at most ``SAMPLE_PER_PIVOT * most_pivots`` classes.

    Equal rows and rows with one id count as vectors of their own. A null id is
    never the smallest while another is reachable; a component of null ids
    only keeps all its rows, which nothing tells apart. An empty table gives no
    rows.
    """
    vectors = keyed_vectors(rows, store, id_col, vector_col, label_col)
    folded = vectors.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("group").alias("group"),
        F.min("vec_id").alias("least"),
        F.count("*").alias("n"),
        F.min("v").alias("v"),
    )
    classes = store.keep(folded.withColumn("cid", F.monotonically_increasing_id()), "classes")

    n_pivots = min(most_pivots, max(LEAST_PIVOTS, 1 << math.ceil(math.log2(classes.count() / CLASSES_PER_PIVOT + 1))))
    sampled = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_PER_PIVOT * n_pivots).select("v").collect()
    of_dim: dict[int, list] = {}
    for r in sampled:
        of_dim.setdefault(len(r.v), []).append(r.v)
    pivots = {dim: choose_pivots(units_of(np.array(v, float)), n_pivots, dim) for dim, v in of_dim.items()}

    indexed = store.keep(described(classes, pivots, nearest), "indexed")
    members = store.keep(with_units(indexed, leaders_of(indexed, store), threshold), "members")
    units = store.keep(summarised(members), "units")

    listed = units.select("unit", "group", "size", "radius", "centre", "tops", F.explode("tops").alias("pivot"))
    lists = dealt(listed, ["pivot", "group"], F.col("unit"), block, store)
    lists = lists.select("cell", "half", "pivot", "unit", "size", "radius", "centre", "tops")
    compared = lists.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare_units(threshold, shared), OUTCOME)
    found = store.keep(compared, "compared_units")

    unsure = found.where("kind = 'unsure'").select("a", "b")
    opened = members_dealt(unsure, members, block, store).repartition("cell").sortWithinPartitions("cell")
    closer = store.keep(opened.mapInArrow(compare_members(threshold), OUTCOME), "compared_members")

    def links(of: DataFrame, name: str) -> DataFrame:
        return of.where("kind = 'links'").groupBy(F.col("a").alias(name)).agg(F.sum("n").alias(f"{name}_links"))

    edges = found.where("kind = 'edge'").unionByName(closer.where("kind = 'edge'")).select("a", "b").distinct()
    components = connected_components(edges, store)
    placed = units.select("unit", "size", "least").join(
        components.select(F.col("vertex").alias("unit"), "component"), "unit", "left"
    )
    placed = placed.withColumn("component", F.coalesce("component", "unit"))
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_unit = placed.join(named, "component").join(links(found, "unit"), "unit", "left")
    of_unit = store.keep(of_unit.select("unit", "size", "component_id", "unit_links"), "unit_results")

    n_links = F.col("size") - 1 + F.coalesce("unit_links", F.lit(0)) + F.coalesce("cid_links", F.lit(0))
    of_class = members.select("cid", "unit").join(of_unit, "unit").join(links(closer, "cid"), "cid", "left")
    of_class = of_class.select("cid", "component_id", n_links.alias("n_links"))
    of_key = store.keep(classes.select("cid", "key").join(of_class, "cid").drop("cid"), "class_results")

    linked = vectors.where(F.col("key").isNotNull()).select("vec_id", "key").join(of_key, "key")
    alone = vectors.where(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id")
    )
    both = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
