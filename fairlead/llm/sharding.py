"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard levels. At each level every child draws
-ln(u) / weight, where u is a hash of the key and the child's path, and the
smallest draw wins, so a child is chosen in proportion to its weight. A draw
depends on the key, the child and the child's weight alone: when weights change,
keys move only into subtrees that grew or out of subtrees that shrank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import row_hash


@dataclass(frozen=True)
class Node:
    """A region, a rack, or (without children) a shard."""

    name: str
    children: tuple[Node, ...] = ()
    own_weight: float = 1.0
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def build_tree(n_shards: int, racks: int = 2, per_rack: int = 2) -> Node:
    """A root over regions of ``racks`` racks of ``per_rack`` shards of weight one."""
    regions: dict[int, dict[int, list[Node]]] = {}
    for s in range(n_shards):
        region, rest = divmod(s, racks * per_rack)
        regions.setdefault(region, {}).setdefault(rest // per_rack, []).append(
            Node(f"shard{s}", shard=s)
        )
    return Node(
        "root",
        tuple(
            Node(f"region{r}", tuple(Node(f"rack{k}", tuple(leaves)) for k, leaves in inside.items()))
            for r, inside in regions.items()
        ),
    )


def grow(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """``tree`` with one more shard in a region and rack of its own.

    No existing subtree changes its weight, so keys move into the new shard only.
    """
    leaf = Node(f"shard{shard}", own_weight=weight, shard=shard)
    added = Node(f"region-of-{shard}", (Node("rack0", (leaf,)),))
    return replace(tree, children=(*tree.children, added))


def draw(key: Column, path: str, weight: float) -> Column:
    """Exponential draw of a child: smaller with more weight."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 12) + 0.5) * 2.0**-52
    return -F.ln(u) / weight


def descend(key: Column, node: Node, path: str = "") -> Column:
    """Shard of ``key`` below ``node``; ties go to the earlier child."""
    if not node.children:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    below = {c.name: descend(key, c, f"{path}/{c.name}") for c in live}
    if len(live) == 1:
        return below[live[0].name]
    draws = F.array(
        *(
            F.struct(draw(key, f"{path}/{c.name}", c.weight).alias("draw"), F.lit(i).alias("child"))
            for i, c in enumerate(live)
        )
    )
    chosen = F.array_min(draws)["child"]
    return F.element_at(F.array(*below.values()), chosen + 1)


def assign_shards(
    docs: DataFrame,
    tree: Node,
    grown: Node | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_slot_group: int = 20_000,
) -> DataFrame:
    """Shard, dense slot inside the shard and size of every row.

    Returns doc_id, size (bytes of the text plus 1), text_crc32, shard, slot and
    grown_shard (null without ``grown``). A null text has no bytes; a null id is
    a key like any other; rows with one id share a shard; an empty table gives
    no rows. Slots follow (hash group, id, checksum, size), so they do not
    depend on how the input is partitioned. No window holds more than one hash
    group, whose size stays near ``rows_per_slot_group / number of shards`` as
    the table grows; repeated ids are spread over groups by their texts.
    """
    groups = max(32, math.ceil(docs.count() / rows_per_slot_group))
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    key = F.col(id_col).cast("bigint")
    placed = docs.select(
        key.alias("doc_id"),
        (F.octet_length(raw).cast("bigint") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        descend(key, tree).cast("int").alias("shard"),
        (descend(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(key, row_hash(F.col(text_col))), F.lit(groups)).alias("slot_group"),
    )
    before = Window.partitionBy("shard").orderBy("slot_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = placed.groupBy("shard", "slot_group").count().select(
        "shard", "slot_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "slot_group").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("place", F.row_number().over(within))
        .join(offsets, ["shard", "slot_group"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("offset") + F.col("place") - 1).alias("slot"),
            "grown_shard",
        )
    )
