"""What filters do to one another: an audit of every order of application.

Each filter is a relation of the ids that fail it. The survivors of a set of
filters are an anti-join with the relations of that set, what the next filter
removes is a semi-join with its relation. Both depend on the set alone, so the
2**n sets answer for all n! orders.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import sha256_hex, words
from fairlead.sources.stages import StageStore

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a (not null) text alone decides, by filter name."""
    n_words = F.size(words(text))
    distinct = F.size(F.array_distinct(words(text)))
    n_upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n_words < 50,
        "B": 100 * distinct < 65 * n_words,
        "C": 100 * n_upper > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def document_facts(
    docs: DataFrame,
    store: StageStore,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """(id, doc_id, part, digest, copies, A, B, C, D): one row per distinct row of ``docs``.

    Texts stay in the map tasks: the table holds a SHA-256 digest of each. Equal
    rows fold into one row that counts its ``copies``, before the shuffle. A null
    text counts as empty, a null part as the empty string. ``id`` numbers the
    rows of the written table, so null and repeated document ids are told apart.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    flags = text_failures(F.col("text"))
    measured = slim.select(
        "doc_id", "part", sha256_hex(F.col("text")).alias("digest"), *(c.alias(n) for n, c in flags.items())
    )
    # A condition follows from the text, so equal digests have equal flags.
    folded = measured.groupBy("doc_id", "part", "digest", *flags).agg(F.count("*").alias("copies"))
    return store.keep(folded.withColumn("id", F.monotonically_increasing_id()), "facts")


def failing_ids(facts: DataFrame, store: StageStore, names: tuple[str, ...] = ("A", "B", "C", "D")) -> dict[str, DataFrame]:
    """One written table of failing ids per filter; E fails texts that a smaller id has.

    Null document ids are neither smaller nor larger than others: they never
    fail E and make no other row fail.
    """
    tables = {name: store.keep(facts.where(F.col(name)).select("id"), f"fails_{name}") for name in names}
    first = (
        facts.groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where(F.col("least") < F.col("most"))
    )
    # Written, so that the join gets plain shuffles by digest on both sides and
    # adaptive execution can split a text that a third of all rows share.
    first = store.keep(first, "first_ids")
    later = facts.select("id", "digest", "doc_id").join(first, "digest").where(F.col("doc_id") > F.col("least"))
    tables["E"] = store.keep(later.select("id"), "fails_E")
    return tables


def with_labels(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``: whether some label row of the document says so."""
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )
    none = {"good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))}
    return facts.select("id", "doc_id", "part", "copies").join(marks, "doc_id", "left").withColumns(none).drop("doc_id")


def survivors(suspects: DataFrame, fails: Mapping[str, DataFrame], store: StageStore) -> DataFrame:
    """(id, ..., done) for every set ``done`` of filters (a bit mask) that the row survives.

    ``suspects`` are the rows that fail anything; each is repeated once per set
    after the shuffle by id, and one anti-join per filter removes the sets that
    hold a filter the row fails.
    """
    last = (1 << len(fails)) - 1
    alive = suspects.repartition("id").withColumn("done", F.explode(F.sequence(F.lit(0), F.lit(last))))
    for i, failing in enumerate(fails.values()):
        gone = failing.select(F.col("id").alias("gone")).hint("shuffle_hash")
        in_set = F.col("done").bitwiseAND(1 << i) != 0
        alive = alive.join(gone, (F.col("id") == F.col("gone")) & in_set, "left_anti")
    return store.keep(alive, "survivors")


def removals(alive: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """(part, done, bit, removed, good_lost, toxic_lost): what a filter removes after a set."""

    def total(condition: Column | None = None) -> Column:
        counted = F.col("copies") if condition is None else F.when(condition, F.col("copies")).otherwise(0)
        return F.sum(counted)

    united = None
    for i, failing in enumerate(fails.values()):
        bit = 1 << i
        removed = (
            alive.where(F.col("done").bitwiseAND(bit) == 0)
            .join(failing.hint("shuffle_hash"), "id", "left_semi")
            .groupBy("part", "done")
            .agg(
                total().alias("removed"),
                total(F.col("good")).alias("good_lost"),
                total(F.col("toxic")).alias("toxic_lost"),
            )
            .withColumn("bit", F.lit(bit))
        )
        united = removed if united is None else united.unionByName(removed)
    return united


def steps_of_orders(names: list[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, bit mask of the filters before, bit of the filter): n! orders of n steps."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    return [
        ("".join(order), k + 1, sum(bits[f] for f in order[:k]), bits[name])
        for order in permutations(names)
        for k, name in enumerate(order)
    ]


def audit(facts: DataFrame, fails: Mapping[str, DataFrame], labels: DataFrame, store: StageStore) -> DataFrame:
    """One row per part, order of the filters and step, with counts of documents.

    ``kept`` remain after the step, ``removed`` go in it, ``redundant`` fail its
    filter but went earlier, ``unique_fails`` fail its filter and no other,
    ``good_lost`` and ``toxic_lost`` are removed documents of that label,
    ``shapley`` is what the filter removes summed over all orders, at any
    step. Combinations that remove nothing have zeros. Empty tables give no rows.
    """
    names = list(fails)
    n, full = len(names), (1 << len(names)) - 1
    any_failing = fails[names[0]].select("id")
    for name in names[1:]:
        any_failing = any_failing.unionByName(fails[name].select("id"))
    suspects = with_labels(facts.join(any_failing.distinct(), "id", "left_semi"), labels)
    counted = store.keep(removals(survivors(suspects, fails, store), fails), "removals")

    # Every part with every (set, filter), so that nothing removed counts as zero.
    parts = facts.groupBy("part").agg(F.sum("copies").alias("documents"))
    pairs = [(done, 1 << i) for done in range(full + 1) for i in range(n) if not done >> i & 1]
    listed = F.array(*(F.struct(F.lit(d).alias("done"), F.lit(b).alias("bit")) for d, b in pairs))
    grid = parts.select("part", "documents", F.inline(listed)).join(counted, ["part", "done", "bit"], "left")
    measures = ("removed", "good_lost", "toxic_lost")
    grid = grid.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in measures})

    # One row per part holds a map from (set, filter) to its counts: 80 entries for five filters.
    entry = F.struct(F.struct("done", "bit").alias("key"), F.struct(*measures).alias("value"))
    by_part = grid.groupBy("part", "documents").agg(F.map_from_entries(F.collect_list(entry)).alias("by_set"))
    steps = F.array(
        *(
            F.struct(
                F.lit(order).alias("filter_order"), F.lit(k).alias("step"), F.lit(done).alias("done"), F.lit(bit).alias("bit")
            )
            for order, k, done, bit in steps_of_orders(names)
        )
    )

    def at(done: Column | int, bit: Column | int) -> Column:
        done, bit = (x if isinstance(x, Column) else F.lit(x) for x in (done, bit))
        return F.element_at("by_set", F.struct(done.alias("done"), bit.alias("bit")))

    def gone(done: Column) -> Column:
        """Documents removed by a set: those its filters remove one after another."""
        total = F.lit(0).cast("bigint")
        for i in range(n):
            below = done.bitwiseAND((1 << i) - 1)
            total = total + F.when(done.bitwiseAND(1 << i) != 0, at(below, 1 << i)["removed"]).otherwise(0)
        return total

    def shapley(bit: int) -> Column:
        total = F.lit(0).cast("bigint")
        for done, b in pairs:
            if b == bit:
                k = done.bit_count()
                total = total + at(done, bit)["removed"] * (factorial(k) * factorial(n - 1 - k))
        return total

    # Per part and filter: all that fail it, those that fail only it, its Shapley sum.
    of_filter = F.create_map(
        *(
            x
            for i in range(n)
            for x in (
                F.lit(1 << i),
                F.struct(
                    at(0, 1 << i)["removed"].alias("failing"),
                    at(full & ~(1 << i), 1 << i)["removed"].alias("unique_fails"),
                    shapley(1 << i).alias("shapley"),
                ),
            )
        )
    )
    done, bit = F.col("done"), F.col("bit")
    here, filter_ = F.col("here"), F.col("filter")
    return (
        by_part.withColumn("of_filter", of_filter)
        .select("part", "documents", "by_set", "of_filter", F.inline(steps))
        .withColumns({"here": at(done, bit), "filter": F.element_at("of_filter", bit)})
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("documents") - gone(done.bitwiseOR(bit))).alias("kept"),
            here["removed"].alias("removed"),
            (filter_["failing"] - here["removed"]).alias("redundant"),
            filter_["unique_fails"].alias("unique_fails"),
            here["good_lost"].alias("good_lost"),
            here["toxic_lost"].alias("toxic_lost"),
            filter_["shapley"].alias("shapley"),
        )
    )


def audit_documents(
    docs: DataFrame,
    labels: DataFrame,
    store: StageStore,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """:func:`audit` of filters A to E over all rows of ``docs``.

    A: under 50 words; B: fewer than 65 % of the words distinct; C: more than 5 %
    of the characters are A-Z; D: holds one of ``#$%&*|``; E: a smaller id has
    the same text. Rows count as often as they occur; see
    :func:`document_facts` and :func:`failing_ids` for nulls.
    """
    facts = document_facts(docs, store, id_col, text_col, part_col)
    return audit(facts, failing_ids(facts, store), labels, store)
