"""The repair of conversations against exhaustive search and plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from fairlead.llm import catalogue, conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CODES = {"s": cr.SYSTEM, "u": cr.USER, "a": cr.ASSISTANT}


def brute(letters: str, faults: tuple[int, ...]) -> tuple[int, str]:
    """Least (cost, audit) by tables from the last turn back, without bounds."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    later = None
    for i in range(len(letters), -1, -1):
        here = {}
        for inserted, last in product((3, 2, 1, 0), following):
            found = []
            if inserted < 3:
                cost, audit = here[following[last], inserted + 1]
                found.append((cost + 2, "I" + audit))
            if later is None:
                if last in ("", "a"):
                    found.append((0, ""))
            else:
                cost, audit = later[last, 0]
                found.append((cost + 3, "D" + audit))
                if faults[i] not in (cr.BLANK, cr.DUPLICATE):
                    extra = 1 if faults[i] == cr.TRUNCATED else 0
                    for new in {following[last], "s"} if last == "" else {following[last]}:
                        cost, audit = later[new, 0]
                        if new == letters[i]:
                            found.append((cost + extra, "K" + audit))
                        if new in "ua":
                            found.append((cost + 2 + extra, "R" + audit))
            here[last, inserted] = min(found, default=(10**9, ""))
        later = here
    return later["", 0]


def coded(letters: str) -> bytes:
    return bytes(CODES.get(x, cr.OTHER) for x in letters)


def test_search_finds_the_least_audit_of_all_short_conversations():
    for n in range(5):
        for letters in product("suax", repeat=n):
            for faults in product(range(4), repeat=n):
                if n == 4 and hash((letters, faults)) % 29:
                    continue
                assert cr.search(coded("".join(letters)), bytes(faults)) == brute("".join(letters), faults)


def test_search_on_longer_conversations():
    draw = random.Random(7)
    for _ in range(300):
        n = draw.randrange(5, 60)
        letters = "".join(draw.choices("suax", (1, 8, 8, 1), k=n))
        faults = tuple(draw.choices(range(4), (12, 2, 2, 4), k=n))
        assert cr.search(coded(letters), bytes(faults)) == brute(letters, faults)


def test_bounds_never_exceed_the_cost():
    draw = random.Random(8)
    for _ in range(300):
        n = draw.randrange(0, 12)
        letters = "".join(draw.choices("suax", k=n))
        faults = bytes(draw.choices(range(4), k=n))
        bounds = cr.lower_bounds(coded(letters), faults, cr.ENDS, True)
        for i in range(n + 1):
            for state in range(4):
                found = cr.search(coded(letters)[i:], faults[i:], state)
                assert bounds[i][max(0, state - 1)] <= found[0]


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_pieces_put_together_equal_one_search(monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    draw = random.Random(9)
    for _ in range(60):
        n = draw.randrange(1, 40)
        roles = coded("".join(draw.choices("suax", (1, 6, 6, 1), k=n)))
        faults = bytes(draw.choices(range(4), (8, 2, 2, 3), k=n))
        cuts = sorted(draw.sample(range(1, n), min(n - 1, draw.randrange(4))))
        parts = list(zip([0, *cuts], [*cuts, n], strict=True))
        tables = [cr.piece_table(roles[a:b], faults[a:b]) for a, b in parts]
        cost, steps, tail = cr.best_path(tables)
        assert (cost, "".join(a for _, a in steps) + tail) == cr.search(roles, faults)


def brute_repair(rows):
    """Per conversation: counts, cost, audit and repaired lines of (conv, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode()))
        faults, seen = [], set()
        for _, role, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append(
                cr.BLANK if not body else cr.DUPLICATE if (role, text) in seen
                else cr.TRUNCATED if body[-1] not in ".!?" else cr.CLEAN
            )
            seen.add((role, text))
        letters = [role[:1] for _, role, _ in mine]
        cost, audit = brute("".join(x or "x" for x in letters), tuple(faults))
        lines, i, last = [], 0, ""
        for edit in audit:
            wanted = "a" if last == "u" else "u"
            name = {"u": "user", "a": "assistant"}[wanted]
            if edit == "I":
                lines.append(f"{name}:")
                last = wanted
                continue
            _, role, text = mine[i]
            i += 1
            if edit == "K":
                lines.append(f"{role}:{text}")
                last = role[:1]
            elif edit == "R":
                lines.append(f"{name}:{text}")
                last = wanted
        turns = [t for t, _, _ in mine if t is not None]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count(cr.BLANK), faults.count(cr.DUPLICATE), faults.count(cr.TRUNCATED),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])),
            cost, audit, "\n".join(lines),
        )
    return out


def repaired(df, store):
    found = cr.repair(df, store)
    texts = {}
    for r in sorted(found.turns.collect(), key=lambda r: (r.at, r.place)):
        texts.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    digests = {r.conv: r.sha256 for r in cr.joined_sha256(found.turns).collect()}
    out = {}
    for r in found.report.collect():
        lines = "\n".join(texts.get(r.conv, []))
        if r.conv in digests:
            assert digests[r.conv] == hashlib.sha256(lines.encode()).hexdigest()
        assert r.conv not in out
        out[r.conv] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, lines)
    return out


EDGES = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."),
    (2, 0, "user", "No end"), (2, 5, "user", "Again."), (2, 5, "assistant", "  "),
    (3, None, "assistant", "No turn."), (3, None, None, "No role."), (3, 2, "user", None), (3, 2, "", "."),
    (None, 0, "user", "No conversation."), (None, 0, "user", "No conversation."), (None, None, None, None),
    (4, 7, "tool", "Other role."), (4, 8, "student", "Starts with s."), (4, 9, "user", "Was it?\n\t "),
    (5, 0, "user", "x" * 300_000 + "."), (5, 1, "assistant", "漢字。"), (5, 2, "assistant", "y" * 300_000),
    (6, 0, "user", ""), (7, -3, "a", "Short role."), (7, 3, "u", "u."),
]


def test_edge_rows_match_brute_force(spark, store):
    df = spark.createDataFrame(EDGES, SCHEMA)
    extra = ("at string", "slot int", "conv string", "place int", "said string", "code int", "piece int", "salt int")
    wide = df.select("*", *(F.lit(None).cast(e.split()[1]).alias(e.split()[0]) for e in extra))
    assert repaired(wide.repartition(3), store) == brute_repair(EDGES)


def test_empty_table(spark, store):
    assert repaired(spark.createDataFrame([], SCHEMA), store) == {}


def test_random_conversations_in_any_layout(spark, store):
    draw = random.Random(11)
    rows = [
        (draw.randrange(40), draw.choice([None, *range(12)]), draw.choice(["user", "assistant", "system", "tool"]),
         draw.choice(["a.", "b", "c!", "", " ", "long enough?"]))
        for _ in range(600)
    ]
    want = brute_repair(rows)
    for n in (1, 7):
        assert repaired(spark.createDataFrame(rows, SCHEMA).repartition(n), store) == want


def test_a_conversation_that_spans_many_tasks(spark, store):
    """A third of all rows in one conversation: ranges cut it, the repair is that of the whole."""
    draw = random.Random(12)
    rows = [(0, i, draw.choice(["user", "assistant"]), draw.choice(["yes.", f"turn {i}", f"turn {i}."])) for i in range(4_000)]
    rows += [(1 + i // 8, i % 8, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(8_000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(16)
        turns = cr.ordered_turns(df, store, "conv_id", "turn", "role", "text")
        sizes = [r["count"] for r in turns.where("conv = 0").groupBy("slot").count().collect()]
        assert len(sizes) > 1 and max(sizes) < 4_000
        got = repaired(df, store)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got[0] == brute_repair([r for r in rows if r[0] == 0])[0]
    assert all(got[c][5:7] == (0, "KKKKKKKK") for c in range(1, 1_001))


def test_equal_rows_are_dealt_to_several_ranges(spark, store):
    """Copies of one row cannot fill a range, and all but one are duplicates."""
    df = spark.range(30_000).select(
        F.lit(5).cast("bigint").alias("conv_id"), F.lit(1).cast("bigint").alias("turn"),
        F.lit("user").alias("role"), F.lit("same.").alias("text"),
    )
    assert repaired(df, store) == {5: (0, 0, 29_999, 0, 29_999, 3 * 29_999 + 2, "K" + "D" * 29_999 + "I", "user:same.\nassistant:")}


def test_damage_of_the_query(spark):
    """Faults follow the checksum of conversation and turn; nulls are one space."""
    import zlib

    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(30), None) for r, x in (("assistant", "A. b! c?"), (None, None))]
    got = sorted(map(str, catalogue.damaged(spark.createDataFrame(rows, SCHEMA)).collect()))
    want = []
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if fault == 0:
            continue
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        r = "user" if fault == 4 else r
        want += [(c, t, r, x)] * (2 if fault == 3 else 1)
    frame = spark.createDataFrame(want, SCHEMA).collect()
    assert got == sorted(map(str, frame))


def test_a_conversation_without_rows_after_damage(spark, tmp_path):
    """Row 0:11 is dropped; its conversation stays with zeros."""
    import zlib

    turn = next(t for t in range(500) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(0, turn, "user", "x.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = catalogue.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
