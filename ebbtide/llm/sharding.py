"""Sharding by a hierarchical weighted hash tree: region, rack and shard.

At each level every child makes a draw from (row key, child's name) and its weight, and
the row descends into the child with the best draw. A draw depends on that child alone.
So a changed weight moves rows only into or out of the subtree whose weight changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import stored, text_of, unused

BITS = 48
SUB_BUCKETS = 64


@dataclass(frozen=True)
class Node:
    """A region, a rack or (with ``shard``) a leaf. An inner node weighs what its leaves weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return self.leaf_weight if self.shard is not None else sum(c.weight for c in self.children)


def uniform_tree(shards: int, regions: int = 4, racks: int = 2) -> Node:
    """Shards 0 to ``shards`` - 1 dealt evenly to regions and racks, each of weight 1."""
    placed: list[list[list[Node]]] = [[[] for _ in range(racks)] for _ in range(regions)]
    for s in range(shards):
        placed[s % regions][s // regions % racks].append(Node(f"shard-{s}", shard=s))
    tops = []
    for r, region in enumerate(placed):
        inner = [Node(f"region-{r}/rack-{k}", tuple(x)) for k, x in enumerate(region) if x]
        if inner:
            tops.append(Node(f"region-{r}", tuple(inner)))
    return Node("root", tuple(tops))


def with_new_shard(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, as a region of its own.

    No weight of an existing subtree changes, so rows move into the new shard only. (A
    shard added to a rack would raise the weight of that rack and region, and rows won by
    the region might then fall to one of its old shards.)
    """
    leaf = Node(f"shard-{shard}", shard=shard, leaf_weight=weight)
    rack = Node(f"region-of-{shard}/rack", (leaf,))
    return Node(tree.name, (*tree.children, Node(f"region-of-{shard}", (rack,))))


def _draw(key: Column, child: Column) -> Column:
    """An exponential waiting time with the child's weight as rate: the first one wins."""
    digits = F.substring(F.md5(F.concat_ws("|", key, child["name"])), 1, BITS // 4)
    uniform = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << BITS)
    return -F.log(uniform) / child["weight"]


def _children_by_name(tree: Node) -> tuple[Column, int]:
    """The tree as a constant map from a node's name to its children, and its depth."""
    entries: list[Column] = []
    level, depth = [tree], 0
    while level:
        for node in level:
            children = [
                F.struct(
                    F.lit(c.name).alias("name"),
                    F.lit(float(c.weight)).alias("weight"),
                    F.lit(c.shard).cast("int").alias("shard"),
                )
                for c in node.children
            ]
            entries += [F.lit(node.name), F.array(*children)]
        level = [c for node in level for c in node.children if c.shard is None]
        depth += 1
    return F.create_map(*entries), depth


def reached_shard(key: Column, tree: Node) -> Column:
    """The shard that ``key`` reaches: at each level the child with the smallest draw.

    All leaves must be equally deep, as in region, rack and shard.
    """
    children, depth = _children_by_name(tree)
    best = None
    for _ in range(depth):
        name = F.lit(tree.name) if best is None else best["child"]["name"]
        best = F.array_min(
            F.transform(
                F.element_at(children, name),
                lambda c: F.struct(_draw(key, c).alias("draw"), c.alias("child")),
            )
        )
    return best["child"]["shard"]


def assign_shards(
    docs: DataFrame, shards: int = 40, tree: Node | None = None, label: str = "sharded"
) -> DataFrame:
    """One row per row of ``docs``: where it goes, by doc_id and the tree alone (law ``key``).

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32 (unsigned), law,
    shard, slot (gapless from 0 in each shard, in the order of a hash bucket, doc_id,
    checksum and size) and grown_shard (with one more shard). A missing text has no bytes;
    a missing doc_id is a key like any other; repeated rows get a slot each; an empty
    table gives an empty result; other columns are ignored.

    No text is shuffled. Rows of a shard are numbered in 64 buckets each, linked by the
    buckets' counts (shards times 64 rows, which bounds the broadcast).
    """
    tree = tree or uniform_tree(shards)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 16).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumns(
        {
            "shard": reached_shard(key, tree),
            "grown_shard": reached_shard(key, with_new_shard(tree, shards)),
        }
    )
    spread = F.substring(F.md5(F.concat_ws("|", key, "text_crc32", "size")), 1, 2)
    bucket = F.pmod(F.conv(spread, 16, 10).cast("int"), F.lit(SUB_BUCKETS))
    rows = stored(rows.withColumn("_bucket", bucket), label)
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    starts = counts.select(
        "shard", "_bucket", (F.sum("_rows").over(before) - F.col("_rows")).alias("_start")
    )
    place = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_place", F.row_number().over(place))
        .join(F.broadcast(starts), ["shard", "_bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_start") + F.col("_place") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``docs`` with all columns and the shard of each row; nothing is shuffled.

    The new column is ``shard``, with underscores appended where ``docs`` has such a column.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    return docs.withColumn(unused(docs, "shard"), reached_shard(key, uniform_tree(shards)))
