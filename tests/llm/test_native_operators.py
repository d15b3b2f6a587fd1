"""Sharding, quality rules, mixing and line dedup."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from fairlead.llm import line_dedup, mixing, oracle, quality_rules, sharding

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def spark_hash(key: int, path: str) -> int:
    seed = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    return xxhash.xxh64_intdigest(path.encode(), seed=seed)


def brute_shard(key: int, node, path="") -> int:
    if not node.children:
        return node.shard
    draws = [
        (-math.log(((spark_hash(key, f"{path}/{c.name}") >> 12) + 0.5) * 2.0**-52) / c.weight, i)
        for i, c in enumerate(node.children)
    ]
    child = node.children[min(draws)[1]]
    return brute_shard(key, child, f"{path}/{child.name}")


def test_shards_follow_the_hash_tree(spark):
    tree = sharding.build_tree(8)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.assign_shards(docs, tree, sharding.grow(tree, 8)).collect()
    grown = sharding.grow(tree, 8)
    assert all(r.shard == brute_shard(r.doc_id, tree) for r in rows)
    assert all(r.grown_shard == brute_shard(r.doc_id, grown) for r in rows)
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) < 1.3 * min(counts.values())
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))


def test_weights_move_keys_only_into_grown_subtrees(spark):
    tree = sharding.build_tree(8)
    first, *others = tree.children
    rack = first.children[0]
    heavier = sharding.replace(rack, children=tuple(sharding.replace(s, own_weight=2.0) for s in rack.children))
    changed = sharding.replace(tree, children=(sharding.replace(first, children=(heavier, *first.children[1:])), *others))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.assign_shards(docs, tree, changed).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    # Regions 0 to 3 and 4 to 7: whatever moves ends in the region that grew.
    assert moved and all(r.grown_shard < 4 for r in moved)


def test_sharding_edge_cases(edge_docs, no_docs, edge_rows):
    tree = sharding.build_tree(8)
    rows = sharding.assign_shards(edge_docs, tree).collect()
    assert len(rows) == len(edge_rows)
    expected = Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert all(r.grown_shard is None for r in rows)
    assert sharding.assign_shards(no_docs, tree).count() == 0


def brute_counts(text):
    tokens = SPACE.findall(text or "")
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(tokens), sum(map(len, tokens)), symbols, len(lines) - len(set(lines)), len(covered)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_quality_counts_match_brute_force(edge_docs, edge_rows, make_docs):
    got = Counter(tuple(r) for r in quality_rules.judge(edge_docs).select("doc_id", *COUNTS).collect())
    assert got == Counter((d, *brute_counts(t)) for d, t, *_ in edge_rows)
    texts = ["a b c a b c a b", "x x x x x", "a b c d", "p q\np q\n \np q", "# $ | a"]
    rows = quality_rules.judge(make_docs(texts)).orderBy("doc_id").select(*COUNTS).collect()
    assert [tuple(r) for r in rows] == [brute_counts(t) for t in texts]


def test_long_texts_fall_back_to_all_positions(make_docs, monkeypatch):
    monkeypatch.setattr(quality_rules, "PACKED_POSITIONS", 4)
    texts = ["a b c d a b c d e f g", "a b c"]
    rows = quality_rules.measured(make_docs(texts)).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in rows] == [brute_counts(t)[-1] for t in texts]


def test_quality_verdicts(make_docs, no_docs):
    plain = " ".join(f"the word{i} of" for i in range(40))
    texts = [plain, "short one", plain.replace(" of", " #$%"), " ".join(f"nonsense{i}" for i in range(90)), "a b c " * 40]
    rows = quality_rules.judge(make_docs(texts)).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, False, False, False, False]
    assert [r.base_failed for r in rows] == [False, True, False, False, True]
    assert rows[2].failed == ["symbol_ratio"] and rows[3].failed == ["stop_word_ratio"]
    assert quality_rules.judge(no_docs).count() == 0


def brute_sainte_lague(votes, seats):
    quotients = sorted(
        ((-v / (2 * k + 1), i, k) for i, v in enumerate(votes) if v > 0 for k in range(seats + 1))
    )
    return [sum(1 for q in quotients[:seats] if q[1] == i) for i in range(len(votes))]


@pytest.mark.parametrize(
    "votes, seats", [([53, 24, 23], 7), ([1, 1, 1, 1], 6), ([1000, 1, 1, 1, 1, 1, 1], 15), ([0, 0], 4), ([5], 3), ([9, 0, 2], 0)]
)
def test_sainte_lague_matches_ranking_all_quotients(spark, votes, seats):
    df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, item int, votes double, seats bigint")
    rows = mixing.sainte_lague(df, ["g"], "item", "votes", "seats").orderBy("item").collect()
    assert [r.quota for r in rows] == brute_sainte_lague(votes, seats)


def test_targets_are_shared_by_weight_up_to_the_cap(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, None: 500}
    rows = mixing.capped_targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size bigint"), (3, 1, 2), 1.5, 2
    ).collect()
    got = {r.source: r.target for r in rows}
    weights = dict(zip(["a", "b", "c", None], (3, 1, 2, 3), strict=True))
    want, open_, room = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        level = room / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            room -= want[s]
        open_ -= over
    want |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(want)


def test_mix_takes_near_target_and_never_too_much(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 211)), "en", f"s{i % 4}", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mixed = mixing.mix(docs, rows_per_shard=50, block_words=16)
    got = mixed.collect()
    assert len(got) == 400 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
    for r in got:
        assert abs(taken[r.source] - r.target) <= 16 * 10
    again = mixing.mix(docs.repartition(7), rows_per_shard=50, block_words=16).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    out = mixing.mixed_documents(docs, rows_per_shard=50, block_words=16)
    n = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    assert n == {r.doc_id: r.taken for r in got if r.taken}


def test_small_shards_hand_on_what_they_cannot_take(spark):
    rows = [(i, "w " * 10, "small") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs, rows_per_shard=1, share=1.5).collect()
    assert all(r.target == 4500 and r.taken <= 20 for r in got)
    assert sum(r.taken for r in got) == 4500 // 32 * 32


def test_mix_of_many_shards_equals_sql(spark, make_docs):
    """Small shards, a hot source and repeated ids; words over a shard's limit are handed on."""
    con = duckdb.connect()
    rows = [(i % 260, "w " * (i * 7919 % 40), "en", ("a", "b", "hot", None)[min(i % 7, 3)], 1) for i in range(500)]
    rows += [(None, None, None, None, None), (None, "x y", None, "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    con.register("documents", docs.toArrow())
    for per_shard in (20, 5):
        sql = oracle.MIXING.replace("/ 20000", f"/ {per_shard}")
        want = con.execute(f"SELECT doc_id, source, size, target, taken FROM ({sql})").fetchall()
        got = mixing.mix(docs, rows_per_shard=per_shard).select("doc_id", "source", "size", "target", "taken").collect()
        assert Counter(map(tuple, got)) == Counter(want)
    assert sum(r.taken for r in got) == sum(r[0] for r in {(w[3], w[1]) for w in want}) // 32 * 32


def test_rows_of_one_id_spread_over_shards(spark):
    rows = [(None if i % 3 else 7, f"text {i}", "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = mixing.mix(docs, rows_per_shard=100, share=0.5).agg(F.sum("taken"), F.max("passes")).first()
    assert taken[0] == 3000 // 32 * 32 and taken[1] == 0


def test_mixing_edge_cases(edge_docs, no_docs, edge_rows):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter(
        (d, len(SPACE.findall(t or ""))) for d, t, *_ in edge_rows
    )
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).columns == no_docs.columns
    assert mixing.mixed_documents(edge_docs).columns == edge_docs.columns
    total = mixing.mixed_documents(edge_docs).agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0]
    assert total == sum(r.taken for r in rows)
    blank = edge_docs.where("doc_id in (2, 3, 4)")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix(blank).collect())


def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders[line.strip(strip).lower()].add(d)
    keep = {k: max(x for x in h if x is not None) for k, h in holders.items() if len(k) >= 40 and len(h) >= 5}
    out = Counter()
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keep.get(x.strip(strip).lower(), d) == d]
        out[(d, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def test_line_dedup_matches_brute_force(edge_docs, edge_rows, no_docs, store):
    bitmaps = line_dedup.keep_bitmaps(edge_docs, store)
    joined = line_dedup.with_bitmaps(edge_docs, bitmaps, "doc_id", "text")
    rows = joined.select("left_id", "n_lines", "n_dropped", line_dedup.kept_text(F.col("whole"), F.col("kept_runs"))).collect()
    assert Counter(tuple(r) for r in rows) == brute_lines(edge_rows)
    out = line_dedup.drop_repeated_lines(edge_docs, store)
    assert out.columns == edge_docs.columns and out.count() == len(edge_rows)
    assert out.where("text is null").count() == 2
    assert line_dedup.drop_repeated_lines(no_docs, store).count() == 0


def test_bitmaps_are_runs_of_kept_lines(spark):
    df = spark.createDataFrame([(7, [0, 3, 4])], "n int, dropped array<int>")
    runs = df.select(line_dedup.kept_runs(F.col("n"), F.col("dropped")).alias("r")).first().r
    assert [tuple(r) for r in runs] == [(1, 2), (5, 2)]


def test_native_plans_run_no_python(edge_docs, store):
    tree = sharding.build_tree(8)
    for df in (
        sharding.assign_shards(edge_docs, tree),
        mixing.mix(edge_docs),
        mixing.mixed_documents(edge_docs),
        line_dedup.drop_repeated_lines(edge_docs, store),
        quality_rules.judge(edge_docs),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_one_id_and_text_in_two_sources(spark):
    """Every source's words in the mixed rows are those the mix takes, in any order of the rows."""
    text = " ".join(f"w{i}" for i in range(96))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "b", 1), (1, text, "de", "b", 1), (1, text, "en", None, 1)]
    rows += [(None, text, "en", "a", 1)] * 3 + [(2, None, "en", "b", 1), (3, "x y z", None, "b", 2), (3, "x y z", None, "b", 2)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    seen = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, schema).repartition(3)
        want, got = Counter(), Counter()
        for r in mixing.mix(docs).collect():
            want[r.source, r.doc_id] += r.taken
        mixed = mixing.mixed_documents(docs).collect()
        for r in mixed:
            got[r.source, r.doc_id] += len(SPACE.findall(r.text))
        assert +got == +want
        seen.add(tuple(sorted(map(str, mixed))))
    assert len(seen) == 1
