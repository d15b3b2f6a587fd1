"""Near-duplicate vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairlead.llm import embedding_dedup as ed

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = math.nan, math.inf


def truth(rows, threshold=0.93):
    """Links of each row by index and the smallest index sets, straight from the definition."""

    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float32).astype(float)
        a = a / np.abs(a).max()
        return a / np.linalg.norm(a)

    units = [None if label is None else unit(v) for _, v, label in rows]
    groups = {}
    for i, u in enumerate(units):
        if u is not None:
            groups.setdefault((rows[i][2], len(u)), []).append(i)
    linked = [set() for _ in rows]
    for members in groups.values():
        m = np.array([units[i] for i in members])
        close = m @ m.T >= threshold
        np.fill_diagonal(close, False)
        for a, b in zip(*np.nonzero(close), strict=True):
            linked[members[a]].add(members[b])
    return linked


def components(rows, linked):
    seen, out = [None] * len(rows), []
    for i in range(len(rows)):
        if seen[i] is None:
            stack, mine = [i], [i]
            seen[i] = i
            while stack:
                for j in linked[stack.pop()]:
                    if seen[j] is None:
                        seen[j] = i
                        stack.append(j)
                        mine.append(j)
            least = min((rows[j][0] for j in mine if rows[j][0] is not None), default=None)
            out += [(j, least) for j in mine]
    return [least for _, least in sorted(out)]


def wanted(rows):
    linked = truth(rows)
    return sorted(
        ((r[0], len(linked[i]), c, r[0] == c) for i, (r, c) in enumerate(zip(rows, components(rows, linked), strict=True))),
        key=str,
    )


def found(df, store, **options):
    return sorted((tuple(r) for r in ed.near_duplicate_vectors(df, store, **options).collect()), key=str)


def near(rng, base, cosine):
    """A vector at exactly this cosine from ``base``."""
    base = base / np.linalg.norm(base)
    side = rng.normal(size=len(base))
    side -= (side @ base) * base
    return cosine * base + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def test_edge_rows_match_brute_force(spark, store):
    a, b = [1.0, 0.0, 0.5], [0.9, 0.1, 0.5]
    rows = [
        (1, a, 0), (2, a, 0), (2, a, 0), (3, b, 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [0.0, -0.0, 0.0], 0),
        (8, [1.0, NAN, 0.5], 0), (9, [1.0, INF, 0.5], 0), (10, [1.0, None, 0.5], 0), (11, [], 0), (12, [*a, 0.0], 0),
        (13, [2.0, 0.0, 1.0], 0), (14, [-1.0, 0.0, -0.5], 0), (15, [-0.0, 0.0, 1.0], 2), (16, [0.0, -0.0, 1.0], 2),
        (17, [3e38, 0.0, 1.5e38], 0), (18, [1e-44, 0.0, 0.0], 3), (19, [1e-44, 1e-45, 0.0], 3),
        (None, a, 0), (None, b, 4), (None, b, 4), (None, None, None), (-5, [0.0, 1.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    names = "key group cid n least u tops unit centre angle cell half pivot component_id kept v size".split()
    wide = df.select("*", *(F.lit(None).cast("string").alias(name) for name in names))
    assert found(wide.repartition(3), store) == wanted(rows)


def test_empty_table(spark, store):
    assert found(spark.createDataFrame([], SCHEMA), store) == []


def test_one_vector(spark, store):
    assert found(spark.createDataFrame([(7, [1.0], 0)], SCHEMA), store) == [(7, 0, 7, True)]


def clustered(seed, noise, n_clusters=6, size=60, dim=16, singles=200):
    """Clusters whose pairs lie on both sides of the threshold, and single vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_clusters):
        base = rng.normal(size=dim)
        base /= np.linalg.norm(base)
        for _ in range(size):
            v = base + rng.normal(size=dim) * noise / math.sqrt(dim)
            rows.append((len(rows), v.tolist(), c % 2))
    rows += [(len(rows) + i, rng.normal(size=dim).tolist(), i % 3) for i in range(singles)]
    return rows


@pytest.mark.parametrize("noise", [0.05, 0.25, 0.4])
def test_links_are_exact_when_every_pair_is_a_candidate(spark, store, noise):
    """All pivots named: units, open pairs and blocks decide every pair as brute force does."""
    rows = clustered(int(noise * 100), noise)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, store, nearest=64, shared=1, block=16) == wanted(rows)


@pytest.mark.parametrize(("cosine", "dim"), [(0.9301, 64), (0.95, 64), (0.9301, 16), (0.98, 128)])
def test_recall_against_brute_force(spark, store, cosine, dim):
    """Pairs near the threshold among random vectors: at least nine in ten found, none below."""
    rng = np.random.default_rng(dim)
    rows = []
    for i in range(1_000):
        base = rng.normal(size=dim)
        rows.append((2 * i, base.tolist(), i % 4))
        rows.append((2 * i + 1, near(rng, base, cosine).tolist(), i % 4))
    linked = truth(rows)
    got = {r.vec_id: r for r in ed.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), store).collect()}
    assert all(got[r[0]].n_links <= len(linked[i]) for i, r in enumerate(rows))
    true = sum(map(len, linked))
    assert true >= 1_900 and sum(r.n_links for r in got.values()) >= 0.98 * true


def test_recall_where_copies_fill_the_sample(spark, store):
    """Two thirds of all rows are copies of one vector: pivots stay spread and links whole."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=64)
    rows = [(i, near(rng, base, 0.99).tolist(), 0) for i in range(2_000)]
    rows += [(2_000 + i, rng.normal(size=64).tolist(), 0) for i in range(1_000)]
    assert found(spark.createDataFrame(rows, SCHEMA), store) == wanted(rows)


def test_rows_made_grow_with_the_rows_and_not_with_pairs(spark, tmp_path):
    """Large groups of equal and of nearly equal vectors: no step writes a row per pair."""
    from fairlead.llm.stages import Stages

    written = {}

    class Counted(Stages):
        def keep(self, df, name):
            table = super().keep(df, name)
            written[name] = max(written.get(name, 0), table.count())
            return table

    rng = np.random.default_rng(4)
    base = rng.normal(size=32)
    rows = [(i, base.tolist(), 0) for i in range(3_000)]
    rows += [(3_000 + i, near(rng, base, 0.991).tolist(), 0) for i in range(1_500)]
    rows += [(4_500 + i, rng.normal(size=32).tolist(), 0) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(df, Counted(spark, str(tmp_path)))
    assert got == wanted(rows)
    # 10 million pairs link; a member is written once for each unit it is compared with.
    assert sum(r[1] for r in got) > 20_000_000 and max(written.values()) <= 6 * len(rows), written


def test_pivots_are_spread_and_complete():
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    sample = ed.units_of(np.array([near(rng, base, 0.999) for _ in range(50)]))
    pivots = ed.choose_pivots(sample, 64, 8)
    assert pivots.shape == (64, 8) and np.allclose(np.linalg.norm(pivots, axis=1), 1)
    assert sum((pivots @ sample[0]) > 0.99) == 1


def test_spanning_edges_keep_components():
    rng = np.random.default_rng(6)
    linked = np.triu(rng.random((80, 80)) < 0.02, 1)
    linked = linked | linked.T
    edges = ed.spanning(linked)
    rows = [(i, None, None) for i in range(80)]
    before = components(rows, [set(np.flatnonzero(r).tolist()) for r in linked])
    kept = [set() for _ in rows]
    for a, b in edges:
        assert linked[a, b]
        kept[a].add(b)
        kept[b].add(a)
    assert components(rows, kept) == before and len(edges) == 80 - len(set(before))
