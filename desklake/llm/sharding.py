"""Hierarchical weighted hash tree: documents descend region, rack and shard by weighted hash draws.

At each node every child draws ``-ln(u) / weight`` with ``u`` a hash of document id and child name, and the smallest draw wins, so
a child gets its share of the weight and a changed weight moves rows only into or out of that child's subtree. Weights of inner
nodes are sums over their shards. ``grow`` adds a shard as a region of its own: no other weight changes, so rows move into
the new shard and nowhere else, however often a tree has grown.

Defined cases: a null text has size 8 and checksum 0; a null id draws like any other value (all such rows share a shard); repeated
rows go to one shard and get a slot each; columns beside doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_GROUP = 500_000  # rows numbered together in one task


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(child.weight for child in children), tuple(children))


def balanced_tree(regions: int, racks: int, shards: int) -> Node:
    """Regions of racks of shards, numbered from 0, each shard of weight 1."""
    def rack(r: int, k: int) -> Node:
        first = (r * racks + k) * shards
        return inner(f"region{r}/rack{k}", [Node(f"shard{first + s}", 1.0, shard=first + s) for s in range(shards)])
    return inner("root", [inner(f"region{r}", [rack(r, k) for k in range(racks)]) for r in range(regions)])


def shard_count(tree: Node) -> int:
    return 1 if tree.shard is not None else sum(shard_count(child) for child in tree.children)


def grow(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    number = shard_count(tree)
    leaf = Node(f"shard{number}", weight, shard=number)
    region = inner(f"grown{number}", [inner(f"grown{number}/rack0", [leaf])])
    return inner(tree.name, [*tree.children, region])


def draw(key: Column, children: tuple[Node, ...]) -> Column:
    """Position of the child that wins the weighted draw."""
    def score(child: Node) -> Column:
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return -F.ln(uniform) / F.lit(child.weight)
    if len(children) == 1:
        return F.lit(0)
    return F.array_min(F.array(*[F.struct(score(child).alias("score"), F.lit(i).alias("child"))
                                 for i, child in enumerate(children)]))["child"]


def descend(key: Column, node: Node) -> Column:
    """The shard a key reaches below the node; only the chosen branch is evaluated."""
    if node.shard is not None:
        return F.lit(node.shard)
    won = draw(key, node.children)
    if len(node.children) == 1:
        return descend(key, node.children[0])
    below = [descend(key, child) for child in node.children]
    if all(child.shard is not None for child in node.children):
        return F.array(*below)[won]
    return F.transform(F.array(won), lambda child: _choose(child, below))[0]


def _choose(child: Column, below: list[Column]) -> Column:
    chosen = F.when(child == 0, below[0])
    for position in range(1, len(below)):
        chosen = chosen.when(child == position, below[position])
    return chosen


def assign(docs: DataFrame, tree: Node, group_rows: int = SLOT_GROUP) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard in a tree with one more.

    Slots are numbered in groups of about ``group_rows`` rows, to which the number of rows in earlier groups is added; a shard
    is never sorted or counted in one task.
    """
    key, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    groups = max(1, -(-docs.count() // (group_rows * shard_count(tree))))
    group = F.pmod(F.xxhash64(key, F.lit("slot")), F.lit(groups))
    placed = docs.select(key, (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                         descend(key, tree).alias("shard"), group.alias("slot_group"), descend(key, grow(tree)).alias("grown_shard"))
    counted = placed.groupBy("shard", "slot_group").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("slot_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("shard", "slot_group", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("shard", "slot_group").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "slot_group"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("earlier") + F.col("place")).alias("slot"), "grown_shard")
