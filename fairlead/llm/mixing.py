"""Mixing sources to target weights by Sainte-Lague apportionment.

Texts are cut into blocks of equally many words. The highest quotients
target / (2k + 1) give every source an integer number of blocks, and once more
every shard of a source its part of them. Within a shard documents stand in
seeded order on a ring of words; the quota takes that many blocks of the ring
from a seeded start.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import words

#: Stands for a null id where ids are matched.
NO_ID = -(1 << 63)


def cyclic_weight(place: Column, weights: tuple[int, ...]) -> Column:
    """Weights in turn for places 1, 2, ..."""
    return F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")
    )


def capped_targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Adds ``target`` to one row per source with its ``source_size``.

    Shares of ``share`` times all words follow the weights; a target stops at
    ``most`` times its source, and what is over goes to the others by weight.
    With sources ordered by cap / weight, those before the first whose cap is
    not reached stand at their cap, and one level per weight serves the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        sources.withColumn("weight", cyclic_weight(F.row_number().over(by_name), weights))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("room", F.sum("source_size").over(everything) * share)
        .withColumn("rest", F.col("room") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn(
            "heavy",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
        .withColumn("level", F.col("rest") / F.col("heavy"))
    )
    open_level = F.min(
        F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("cap_rank", "level"))
    ).over(everything)["level"]
    ranked = ordered.withColumn("cap_rank", F.row_number().over(fill))
    return ranked.withColumn("open_level", open_level).select(
        "source",
        "source_size",
        F.least(
            F.col("cap").cast("double"),
            F.coalesce(F.col("open_level") * F.col("weight"), F.col("cap").cast("double")),
        ).alias("target"),
    )


def sainte_lague(df: DataFrame, group: list[str], item: str, votes: str, seats: str) -> DataFrame:
    """Adds ``quota``: seats of each item of a group by highest quotients.

    ``seats`` is the number a group has to give. Final seats lie within
    half the number of items times the item's share, plus a half, of its
    proportional part, so only quotients in that range are ranked: about six
    rows per item in all, however many seats there are. Equal quotients go to
    the smaller item, a null item last.
    """
    peers = Window.partitionBy(*group)
    sized = (
        df.withColumn("all_votes", F.sum(votes).over(peers))
        .withColumn("n_items", F.count(F.lit(1)).over(peers))
        .withColumn("part", F.coalesce(F.try_divide(F.col(votes), F.col("all_votes")), F.lit(0.0)))
        .withColumn("slack", F.col("n_items") * F.col("part") / 2 + 1)
        .withColumn(
            "sure",
            F.greatest(F.lit(0), F.floor(F.col(seats) * F.col("part") - F.col("slack"))).cast("bigint"),
        )
        .withColumn("open", F.ceil(F.col("slack") * 2 + 1).cast("bigint"))
        .withColumn("left", F.col(seats) - F.sum("sure").over(peers))
    )
    quotients = sized.select("*", F.explode(F.expr("sequence(sure, sure + open)")).alias("k"))
    best = Window.partitionBy(*group).orderBy(
        (F.col(votes) / (2 * F.col("k") + 1)).desc(), F.col(item).asc_nulls_last(), "k"
    )
    won = (
        quotients.withColumn("place", F.row_number().over(best))
        .groupBy(*df.columns, "sure")
        .agg(F.count(F.when((F.col("place") <= F.col("left")) & (F.col(votes) > 0), 1)).alias("won"))
    )
    return won.select(*df.columns, (F.col("sure") + F.col("won")).alias("quota"))


def capped_budgets(shard_quotas: DataFrame, block_words: int, most: int) -> DataFrame:
    """Adds ``budget``: words each shard gives, ``most`` times its size at the most.

    Words of quotas over that limit go to the other shards of the source in
    proportion to their room, so a source loses none while it has room.
    """
    source = Window.partitionBy("source")
    so_far = source.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cap, quota = F.col("shard_size") * most, F.col("quota") * block_words
    capped = (
        shard_quotas.withColumn("own", F.least(quota, cap))
        .withColumn("room", cap - F.col("own"))
        .withColumn("all_room", F.sum("room").over(source))
        .withColumn("over", F.least(F.sum(quota - F.col("own")).over(source), F.col("all_room")))
        .withColumn("room_to", F.sum("room").over(so_far))
    )
    # Floors of running shares: whole words that add up, none above its room.
    wide = "CAST(over AS DECIMAL(19, 0)) * CAST({} AS DECIMAL(19, 0)) div all_room"
    share = f"{wide.format('room_to')} - {wide.format('(room_to - room)')}"
    return capped.withColumn("budget", F.col("own") + F.expr(f"CASE WHEN over > 0 THEN {share} ELSE 0 END"))


def seeded(seed: int, *parts: Column) -> Column:
    """Hex digest that fixes a random order or start."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary"))


def digest_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def other_columns(docs: DataFrame, *known: str) -> Column:
    """Hash of the columns that are not ``known``, and of whether they are null."""
    rest = [F.col(c) for c in docs.columns if c not in known]
    return F.xxhash64(F.lit(0), *rest, *(c.isNull() for c in rest))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block_words: int = 32,
    rows_per_shard: int = 20_000,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What the mix takes of every row.

    Returns doc_id, source, size, source_size, target, passes (how often the
    whole text is taken), piece_start and piece_words (a further run of words,
    may wrap around the end of the ring, see ``head_words``), taken. No
    document is taken more than ``most`` times. Sources in code-point order get
    the weights in turn; a null source is a source of its own and comes last.
    Null and empty texts have size 0 and are never taken; without words all
    targets are 0. What a shard cannot take of its quota goes to other shards
    of its source. Equal rows take neighbouring places on the ring.

    Shards are hash groups of about ``rows_per_shard`` rows by id and text, so no
    window holds more than one shard of one source and rows of one id spread.
    """
    shards = max(1, math.ceil(docs.count() / rows_per_shard))
    sized = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("bigint").alias("size"),
        seeded(seed, F.col(id_col)).alias("place"),
        text_digest(F.col(text_col)).alias("row"),
        other_columns(docs, id_col, text_col, source_col).alias("rest_of_row"),
    ).withColumn("shard", F.pmod(digest_number(seeded(seed + 2, F.col("doc_id"), F.col("row"))), F.lit(shards)))

    per_shard = sized.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    per_source = per_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    targets = capped_targets(per_source, weights, share, most)
    all_blocks = F.floor(F.sum("target").over(Window.partitionBy()) / block_words)
    source_quotas = sainte_lague(
        targets.withColumn("blocks", all_blocks.cast("bigint")), [], "source", "target", "blocks"
    ).withColumnRenamed("quota", "source_blocks")
    shard_quotas = sainte_lague(
        per_shard.join(
            source_quotas.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
        ).select("source", "shard", "shard_size", "source_size", "target", "source_blocks"),
        ["source"],
        "shard",
        "shard_size",
        "source_blocks",
    )
    blocks = F.greatest(F.lit(1), F.floor(F.col("shard_size") / block_words))
    spin = digest_number(seeded(seed + 1, F.col("source"), F.col("shard")))
    rings = capped_budgets(shard_quotas, block_words, most).select(
        F.col("source").alias("ring_source"),
        F.col("shard").alias("ring_shard"),
        "shard_size",
        "source_size",
        "target",
        F.expr("CASE WHEN shard_size > 0 THEN budget div shard_size ELSE 0 END").alias("passes"),
        F.coalesce(F.try_mod("budget", "shard_size"), F.lit(0)).alias("rest"),
        (F.pmod(spin, blocks) * block_words).alias("start"),
    )
    ring = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "row", "size", "rest_of_row")
    placed = sized.withColumn("end", F.sum("size").over(ring)).withColumn(
        "begin", F.col("end") - F.col("size")
    )
    stop = F.col("start") + F.col("rest")
    straight = overlap(F.col("begin"), F.col("end"), F.col("start"), F.least(stop, F.col("shard_size")))
    wrapped = overlap(F.col("begin"), F.col("end"), F.lit(0), stop - F.col("shard_size"))
    return (
        placed.join(
            rings,
            F.col("source").eqNullSafe(F.col("ring_source")) & (F.col("shard") == F.col("ring_shard")),
        )
        .withColumn("piece_words", straight)
        .withColumn("head_words", wrapped)
        .select(
            "doc_id",
            "source",
            "row",
            "rest_of_row",
            "size",
            "source_size",
            "target",
            "passes",
            F.greatest(F.lit(0), F.col("start") - F.col("begin")).alias("piece_start"),
            "piece_words",
            "head_words",
            (F.col("passes") * F.col("size") + F.col("piece_words") + F.col("head_words")).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", **options
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a text is taken.

    Whole passes repeat the row; the words of a partial pass, joined by one
    space, make a row of their own. ``chars_col`` is brought up to date. Equal
    rows count each; null ids and sources are values of their own.
    """
    source_col = options.get("source_col", "source")
    keys = ["key_id", "key_source", "key_row", "key_rest"]

    def keyed(id_: Column, source: Column, row: Column, rest: Column) -> list[Column]:
        # Null ids and sources are told apart from every other.
        names = (id_.isNull(), source.isNull()), (F.coalesce(id_.cast("bigint"), F.lit(NO_ID)), F.coalesce(source, F.lit("")))
        values = [F.struct(null, value) for null, value in zip(*names, strict=True)]
        return [c.alias(k) for c, k in zip([*values, row, rest], keys, strict=True)]

    taken = mix(docs, id_col=id_col, text_col=text_col, **options)
    entry = ["passes", "piece_start", "piece_words", "head_words"]
    of_row = taken.select(*keyed(*(F.col(c) for c in ("doc_id", "source", "row", "rest_of_row"))), "taken", *entry)
    # Equal rows may take different words; whichever of them does, the rows made
    # are the same. So what they take is counted, and one of them stands for all.
    entries = of_row.where("taken > 0").groupBy(*keys, *entry).agg(F.count(F.lit(1)).alias("times"))
    copies = of_row.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    whole = docs.select(
        *keyed(F.col(id_col), F.col(source_col), text_digest(F.col(text_col)), other_columns(docs, id_col, text_col, source_col)),
        F.struct("*").alias("doc"),
    )
    single = whole.join(copies, keys, "left_anti")
    folded = whole.join(copies, keys, "left_semi").groupBy(*keys).agg(F.min("doc").alias("doc"))
    joined = (
        single.unionByName(folded)
        .join(entries, keys)
        .select("doc", F.col("doc")[text_col].alias("text"), *entry, "times")
    )

    def piece(tokens: Column, start: Column, n: Column) -> Column:
        return F.when(
            n > 0, F.array_join(F.slice(tokens, (start + 1).cast("int"), n.cast("int")), " ")
        )

    tokens = words(F.col("text"))
    pieces = F.concat(
        F.array_repeat("text", F.col("passes").cast("int")),
        F.array_compact(
            F.array(
                piece(tokens, F.col("piece_start"), F.col("piece_words")),
                piece(tokens, F.lit(0), F.col("head_words")),
            )
        ),
    )
    rows = joined.select("doc", F.explode(pieces).alias("part"), "times")
    rows = rows.select("doc", "part", F.explode(F.expr("sequence(1L, times)"))).drop("col")
    new = {text_col: F.col("part")}
    if chars_col in docs.columns:
        new[chars_col] = F.length("part").cast(docs.schema[chars_col].dataType)
    return rows.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))
