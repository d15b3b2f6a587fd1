"""Cheapest edits that give conversations a legal structure.

A legal conversation is empty, or an optional system turn followed by pairs of
a user's and an assistant's turn. The edits of a conversation are found by
depth-first branch-and-bound: an explicit stack in ASCII order of the edits,
lower bounds of every suffix, an incumbent (cost, audit) and a table per node
(turns read, last role) of the least cost seen there, which cuts off worse
prefixes until no open prefix can beat the incumbent.

A conversation need not fit into one task. Turns are ordered by a range
shuffle that may cut anywhere; every piece is solved for each pair of roles
before and after it, and the pieces of a conversation are put together from
these small tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import SPACE_CHARS
from fairlead.sources.stages import StageStore

# --- Fixed values: costs of the edits and the legal successions of roles ---
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
#: Role that may follow each state besides a system turn at the start.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ENDS = frozenset((START, ASSISTANT))
OTHER = 0  # role code of a turn that is none of the three
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
# --- End of fixed values ---

CLEAN, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
INFINITE = 1 << 60
#: Turns searched together; longer pieces are put together from such chunks.
CHUNK = 256

Table = dict[tuple[int, int], tuple[int, str]]  # (state before, state after) -> (cost, audit)


def lower_bounds(roles: bytes, faults: bytes, goals: frozenset[int], closing: bool) -> list[tuple[int, int, int]]:
    """Least cost of each suffix for a last role that is none or system, user, assistant.

    A relaxation: a system turn may stand anywhere before the first pair and an
    assistant's turn may open, so no completion is cheaper than its bound.
    """
    user, assistant = (0 if s in goals else INFINITE for s in (USER, ASSISTANT))
    free = 0 if goals & {START, SYSTEM} else INFINITE
    if closing:
        user = min(user, assistant + INSERT)
        free = min(free, user + INSERT)
    bounds = [(free, user, assistant)] * (len(roles) + 1)
    for i in range(len(roles) - 1, -1, -1):
        role, fault = roles[i], faults[i]
        if fault in (BLANK, DUPLICATE):
            free, user, assistant = free + DELETE, user + DELETE, assistant + DELETE
        else:
            extra = CUT_OFF if fault == TRUNCATED else 0
            as_user = user + extra + (0 if role == USER else REROLE)
            as_assistant = assistant + extra + (0 if role == ASSISTANT else REROLE)
            as_system = free + extra if role == SYSTEM else INFINITE
            free = min(free + DELETE, as_user, as_assistant, as_system)
            user, assistant = min(user + DELETE, as_assistant), min(assistant + DELETE, as_user)
        user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
        free = min(free, user + INSERT, assistant + INSERT)
        bounds[i] = (free, user, assistant)
    return bounds


def search(
    roles: bytes, faults: bytes, start: int = START, goals: frozenset[int] = ENDS, closing: bool = True
) -> tuple[int, str] | None:
    """Least (cost, audit) that leads from ``start`` to one of ``goals``, None without any.

    ``closing`` allows insertions after the last turn; a piece that is followed
    by another leaves them to the next one.
    """
    n = len(roles)
    bounds = lower_bounds(roles, faults, goals, closing)

    def bound(i: int, state: int) -> int:
        return bounds[i][max(0, state - 1)]

    def moves(i: int, state: int) -> list[tuple[str, int, int, int]]:
        """(edit, turns read, state, cost) of every edit, in ASCII order."""
        out = []
        if i == n:
            return [("I", i, FOLLOWS[state], INSERT)] if closing else out
        role, fault = roles[i], faults[i]
        out.append(("D", i + 1, state, DELETE))
        out.append(("I", i, FOLLOWS[state], INSERT))
        if fault not in (BLANK, DUPLICATE):
            extra = CUT_OFF if fault == TRUNCATED else 0
            following = FOLLOWS[state]
            if role == following or (role == SYSTEM and state == START):
                out.append(("K", i + 1, role, extra))
            if role != following:
                out.append(("R", i + 1, following, REROLE + extra))
        return out

    def spelled(path: tuple | None) -> str:
        edits = []
        while path:
            path, edit = path
            edits.append(edit)
        return "".join(reversed(edits))

    # A first incumbent: always the edit whose bound looks best.
    least, audit = INFINITE, None
    i, state, cost, path, inserted = 0, start, 0, None, 0
    while not (i == n and state in goals):
        options = [(cost + c + bound(j, s), edit, j, s, c) for edit, j, s, c in moves(i, state) if edit != "I" or inserted < 2]
        if not options or min(options)[0] >= INFINITE:
            break
        _, edit, i, state, c = min(options)
        cost, path, inserted = cost + c, (path, edit), inserted + 1 if edit == "I" else 0
    else:
        least, audit = cost, spelled(path)

    # Prefixes come off the stack in ASCII order, so a later one that costs as
    # much at the same node can only lead to greater audits.
    seen = [INFINITE] * (4 * (n + 1))
    stack: list[tuple[int, int, int, tuple | None]] = [(0, start, 0, None)]
    proved = False  # whether the incumbent came off the stack
    while stack:
        i, state, cost, path = stack.pop()
        best = cost + bound(i, state)
        if best > least or (proved and best == least) or best >= INFINITE or cost >= seen[4 * i + state]:
            continue
        seen[4 * i + state] = cost
        if i == n and state in goals:
            least, audit, proved = cost, spelled(path), True
            continue
        stack.extend((j, s, cost + c, (path, edit)) for edit, j, s, c in reversed(moves(i, state)))
    return None if audit is None else (least, audit)


def piece_table(roles: bytes, faults: bytes) -> Table:
    """Best (cost, audit) of a piece for every state before and after it."""
    tables = []
    for at in range(0, len(roles), CHUNK):
        part = roles[at : at + CHUNK], faults[at : at + CHUNK]
        table: Table = {}
        for before in (START, SYSTEM, USER, ASSISTANT):
            for after in (START, SYSTEM, USER, ASSISTANT):
                found = search(*part, before, frozenset((after,)), closing=False)
                if found:
                    table[before, after] = found
        tables.append(table)
    while len(tables) > 1:  # pairwise, so that no audit is copied more than log(n) times
        tables = [joined(*tables[k : k + 2]) for k in range(0, len(tables), 2)]
    return tables[0]


def joined(first: Table, second: Table | None = None) -> Table:
    """Table of two pieces in a row.

    Prefixes that read the same turns and end with one of them are never
    prefixes of one another, so the least of the joined audits is made of
    least ones.
    """
    if second is None:
        return first
    out: Table = {}
    for (before, middle), (cost, audit) in first.items():
        for (entered, after), (more, rest) in second.items():
            if entered == middle:
                found = (cost + more, audit + rest)
                if (before, after) not in out or found < out[before, after]:
                    out[before, after] = found
    return out


def best_path(tables: list[Table]) -> tuple[int, list[tuple[int, str]], str]:
    """Least cost of all pieces, (state before, audit) of each, and the insertions at the end.

    Equal costs are decided by the audits, piece by piece, as no audit of a
    piece is a proper prefix of another. ``place`` is the rank of what was
    joined so far among the states reached, so audits are compared once.
    """
    reached: dict[int, tuple[int, int, tuple | None]] = {START: (0, 0, None)}  # cost, place, path
    for table in tables:
        found: dict[int, tuple[int, int, str, int]] = {}
        for (before, after), (cost, audit) in table.items():
            if before in reached:
                spent, place, _ = reached[before]
                found[after] = min(found.get(after, (INFINITE,)), (spent + cost, place, audit, before))
        places = sorted({(place, audit) for _, place, audit, _ in found.values()})
        reached = {
            after: (cost, places.index((place, audit)), (reached[before][2], before, audit))
            for after, (cost, place, audit, before) in found.items()
        }
    ends = []
    for state, (spent, place, path) in reached.items():
        more, tail = search(b"", b"", state)
        ends.append((spent + more, place, tail, state, path))
    cost, _, tail, _, path = min(ends, key=lambda end: end[:4])
    steps = []
    while path:
        path, before, audit = path
        steps.append((before, audit))
    return cost, steps[::-1], tail


def edits_of(before: int, audit: str, roles: bytes, tail: str = "") -> list[dict]:
    """Per turn: roles inserted before it, its edit, its new role, roles inserted after it."""
    out, waiting, state = [], "", before
    turns = iter(roles)
    for edit in audit + tail:
        if edit == "I":
            state = FOLLOWS[state]
            waiting += "u" if state == USER else "a"
            continue
        role, new = next(turns), None
        if edit == "K":
            state = role
        elif edit == "R":
            state = FOLLOWS[state]
            new = ROLE_NAMES[state]
        out.append({"before": waiting, "edit": edit, "role": new, "after": ""})
        waiting = ""
    if waiting:
        out[-1]["after"] = waiting
    return out


# --- Turns in order ---------------------------------------------------------


def role_code(role: Column) -> Column:
    """State that a kept turn of this role leads to, by its first letter."""
    first = F.left(role, F.lit(1))
    code = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT)
    return code.otherwise(OTHER)


def ordered_turns(
    rows: DataFrame, store: StageStore, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """(conv, turn, role, text, at, slot, ...): turns of all conversations in one order.

    ``at`` rises with conversation, turn (nulls first), role and text; ``slot``
    is the partition it was sorted in. The last sort key deals equal rows to
    several ranges, so no range grows with a conversation or with copies of
    a row; in which order equal rows stand makes no difference.
    """
    slim = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(4096)).alias("salt"),
    )
    order = ["conv", "turn", "role", "text", "salt"]
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    body = F.btrim("text", F.lit(SPACE_CHARS))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    said = F.concat_ws(":", F.length(conv).cast("string"), conv, F.length("role").cast("string"), "role", "text")
    marked = ranged.select(
        "conv", "turn", "role", "text",
        F.monotonically_increasing_id().alias("at"),
        F.spark_partition_id().alias("slot"),
        role_code(F.col("role")).cast("byte").alias("code"),
        (F.length(body) == 0).alias("blank"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.sha2(said.cast("binary"), 256).alias("said"),
    )
    return store.keep(marked, "turns")


def faults_of(turns: DataFrame, store: StageStore) -> DataFrame:
    """(conv, turn, at, slot, code, fault): the first fault of every turn.

    Blank, duplicate (the conversation has role and text at a smaller ``at``) or
    truncated (the last character that is no space does not end a sentence).
    """
    first = turns.groupBy("said").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))
    # Written, so that both sides of the join are plain shuffles, which
    # adaptive execution splits where one saying is frequent.
    repeated = store.keep(first.where("n > 1").drop("n"), "repeated")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("at") > F.col("first_at"), DUPLICATE)
        .when(F.col("truncated"), TRUNCATED)
        .otherwise(CLEAN)
    )
    slim = turns.select("conv", "turn", "at", "slot", "code", "blank", "truncated", "said")
    found = slim.join(repeated, "said", "left")
    return found.select("conv", "turn", "at", "slot", "code", fault.cast("byte").alias("fault"))


# --- Pieces of conversations ------------------------------------------------

ENTRY = "table: array<struct<before: byte, after: byte, cost: bigint, audit: string>>"
PIECE = (
    "struct<first_at: bigint, roles: binary, n_blank: bigint, n_duplicate: bigint, n_truncated: bigint,"
    " n_illegal: bigint, first_turn: bigint, last_turn: bigint, n_turns: bigint, cost: bigint, audit: string,"
    f" {ENTRY}>"
)
EDITS = "array<struct<before: string, edit: string, role: string, after: string>>"
REPORT = (
    "struct<gaps: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint,"
    " cost: bigint, audit: string>"
)


@dataclass
class Piece:
    """Turns of one conversation that lie in one slot."""

    first_at: int
    at_edge: bool  # whether the slot begins with it: turns may come before
    roles: bytearray = field(default_factory=bytearray)
    faults: bytearray = field(default_factory=bytearray)
    illegal: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    n_turns: int = 0

    def add(self, turn: int | None, role: int, fault: int) -> None:
        if self.roles and (self.roles[-1], role) not in LEGAL_PAIRS:
            self.illegal += 1
        self.roles.append(role)
        self.faults.append(fault)
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.n_turns += 1

    def solved(self) -> dict:
        """What the other pieces of its conversation need to know."""
        roles, faults = bytes(self.roles), bytes(self.faults)
        out = {
            "first_at": self.first_at,
            "roles": roles,
            "n_blank": faults.count(BLANK),
            "n_duplicate": faults.count(DUPLICATE),
            "n_truncated": faults.count(TRUNCATED),
            "n_illegal": self.illegal,
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            "n_turns": self.n_turns,
        }
        if not self.at_edge and len(roles) <= CHUNK:
            out["cost"], out["audit"] = search(roles, faults)
        else:
            out["table"] = [
                {"before": b, "after": a, "cost": cost, "audit": audit}
                for (b, a), (cost, audit) in piece_table(roles, faults).items()
            ]
        return out


def solve_slots(conv_type: pa.DataType, piece_type: pa.DataType) -> Callable:
    """Reads turns sorted by slot and place; gives one row per conversation and slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = conv = piece = None
        done: list[tuple] = []

        def close(at_end: bool) -> None:
            if piece is not None:
                piece.at_edge |= at_end  # the slot ends with it: turns may follow
                done.append((conv, piece.solved()))

        def flush() -> pa.RecordBatch:
            convs, pieces = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(pieces, piece_type)], ["conv", "piece"])

        for batch in batches:
            for c, turn, at, s, role, fault in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if s != slot or c != conv or piece is None:
                    close(at_end=s != slot)
                    piece = Piece(at, at_edge=s != slot)
                    slot, conv = s, c
                piece.add(turn, role, fault)
            if done:
                yield flush()
        close(at_end=True)
        if done:
            yield flush()

    return run


def assembled(pieces: list[dict]) -> tuple[dict, list[list[dict]]]:
    """Report of a conversation and the edits of each of its pieces, from pieces in order."""
    if pieces[0]["table"] is None:
        cost, steps, tail = pieces[0]["cost"], [(START, pieces[0]["audit"])], ""
    else:
        tables = [{(e["before"], e["after"]): (e["cost"], e["audit"]) for e in p["table"]} for p in pieces]
        cost, steps, tail = best_path(tables)
    illegal = sum(p["n_illegal"] for p in pieces)
    distinct, last = 0, None
    for k, p in enumerate(pieces):
        if k and (pieces[k - 1]["roles"][-1], p["roles"][0]) not in LEGAL_PAIRS:
            illegal += 1
        distinct += p["n_turns"] - (last is not None and p["first_turn"] == last)
        last = p["last_turn"] if p["last_turn"] is not None else last
    first = next((p["first_turn"] for p in pieces if p["first_turn"] is not None), None)
    report = {
        "gaps": 0 if first is None else last - first + 1 - distinct,
        "blank": sum(p["n_blank"] for p in pieces),
        "duplicate": sum(p["n_duplicate"] for p in pieces),
        "truncated": sum(p["n_truncated"] for p in pieces),
        "illegal": illegal,
        "cost": cost,
        "audit": "".join(audit for _, audit in steps) + tail,
    }
    edits = [
        edits_of(before, audit, p["roles"], tail if k == len(pieces) - 1 else "")
        for k, (p, (before, audit)) in enumerate(zip(pieces, steps, strict=True))
    ]
    return report, edits


def assemble_conversations(conv_type: pa.DataType, edits_type: pa.DataType, report_type: pa.DataType) -> Callable:
    """Reads pieces sorted by conversation and place; a row per piece, the report on the first."""

    def rows(conv, pieces: list[dict]) -> list[tuple]:
        report, edits = assembled(pieces)
        return [
            (conv, p["first_at"], e, None if k else report) for k, (p, e) in enumerate(zip(pieces, edits, strict=True))
        ]

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        convs, firsts, edits, reports = zip(*out, strict=True)
        arrays = [pa.array(convs, conv_type), pa.array(firsts, pa.int64()), pa.array(edits, edits_type), pa.array(reports, report_type)]
        return pa.RecordBatch.from_arrays(arrays, ["conv", "first_at", "edits", "report"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pieces = None, []
        for batch in batches:
            out: list[tuple] = []
            for c, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if pieces and c != conv:
                    out += rows(conv, pieces)
                    pieces = []
                conv = c
                pieces.append(piece)
            if out:
                yield as_batch(out)
        if pieces:
            yield as_batch(rows(conv, pieces))

    return run


@dataclass(frozen=True)
class Repaired:
    """``report``: a row per conversation; ``turns``: the repaired turns, one row each."""

    report: DataFrame
    turns: DataFrame


def repair(
    rows: DataFrame,
    store: StageStore,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repaired:
    """Repairs all conversations of ``rows`` at least cost.

    A turn is blank, a duplicate of an earlier one of its conversation (role and
    text), truncated, or none of these. Blank turns and duplicates are
    deleted (3); others are kept (0, or 1 if truncated), given the role user or
    assistant (2, plus 1 if truncated) or deleted (3); empty turns of user or
    assistant are inserted anywhere (2). The first letters of the roles come
    to match ``(s?(ua)+)?``. Of equally cheap ways the least audit counts, the
    first letters of the edits in order.

    ``report``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``turns``: conv, at, place, role, text, in the order of (at, place) within
    a conversation. Turns of one number are ordered by role and text, null
    numbers come first, null roles and texts count as one space, and a null
    conversation is a conversation. Equal rows are turns of their own, all but
    the first duplicates. An empty table gives empty tables.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    turns = ordered_turns(rows, store, conv_col, turn_col, role_col, text_col)
    kind = turns.schema["conv"].dataType

    def arrow(ddl: str) -> pa.DataType:
        return to_arrow_type(DataType.fromDDL(ddl))

    conv_type = to_arrow_type(kind)
    faulty = faults_of(turns, store).repartition("slot").sortWithinPartitions("slot", "at")
    pieces = faulty.select("conv", F.col("turn").cast("bigint"), "at", "slot", "code", "fault").mapInArrow(
        solve_slots(conv_type, arrow(PIECE)), f"conv {kind.simpleString()}, piece {PIECE}"
    )
    together = pieces.repartition("conv").sortWithinPartitions("conv", "piece.first_at")
    plans = together.mapInArrow(
        assemble_conversations(conv_type, arrow(EDITS), arrow(REPORT)),
        f"conv {kind.simpleString()}, first_at bigint, edits {EDITS}, report {REPORT}",
    )
    plans = store.keep(plans, "plans")
    report = plans.where(F.col("report").isNotNull()).select("conv", "report.*")

    edits = plans.select("first_at", F.posexplode("edits").alias("nth", "change")).select(
        (F.col("first_at") + F.col("nth")).alias("at"), "change"
    )

    def inserted(roles: Column) -> Column:
        letters = F.filter(F.split(roles, ""), lambda x: x != "")
        return F.transform(
            letters,
            lambda x: F.struct(F.when(x == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")),
        )

    own = F.array(F.struct(F.coalesce("change.role", "role").alias("role"), F.col("text").alias("text")))
    stays = F.when(F.col("change.edit") == "D", F.array().cast("array<struct<role: string, text: string>>")).otherwise(own)
    made = F.concat(inserted(F.col("change.before")), stays, inserted(F.col("change.after")))
    repaired = (
        turns.select("conv", "at", "role", "text")
        .join(edits, "at")
        .select("conv", "at", F.posexplode(made).alias("place", "made"))
        .select("conv", "at", "place", "made.role", "made.text")
    )
    return Repaired(report, repaired)


def joined_sha256(turns: DataFrame) -> DataFrame:
    """(conv, sha256): digest of ``role:text`` of all turns in order, joined by newlines.

    The digest of a conversation is a chain, so one task reads all of it, but
    never holds more than a batch.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = turns.schema["conv"].dataType
    conv_type = to_arrow_type(kind)

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        convs, digests = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(digests, pa.string())], ["conv", "sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            found: list[tuple] = []
            lines: Iterable = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for c, line in lines:
                if digest is None or c != conv:
                    if digest is not None:
                        found.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            if found:
                yield as_batch(found)
        if digest is not None:
            yield as_batch([(conv, digest.hexdigest())])

    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "at", "place").select("conv", line)
    return ordered.mapInArrow(run, f"conv {kind.simpleString()}, sha256 string")
