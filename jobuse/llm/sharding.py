"""Placement of documents in shards by a hierarchical weighted hash tree.

The tree has regions, racks and shards. A key descends it from the root: at each
level every child draws ``-ln(u) / weight``, with ``u`` a hash of the key and the
child's name, and the least draw wins. A node's weight is the sum of the weights
beneath it, so a shard gets its share of the whole. Draws depend on nothing but
the key, the child and its weight; when a weight changes, keys move only into or
out of that child, and so only within the subtrees whose weights changed.

A shard added to a tree opens a region of its own. No other node's weight
changes, so rows move into the new shard and nowhere else: the law ``key``.

Placement is by id alone: rows of one id are in one shard, rows without an id in
one shard of their own choosing. Size and checksum of a null text are those of an
empty one. Repeated rows each get a slot. Extra columns are dropped.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobuse.session import cut

ROW_BYTES = 16          # besides the text
SLOT_BUCKETS = 1024     # a shard's rows are numbered in this many parts


@dataclass(frozen=True)
class Tree:
    """``regions[r][k]`` are the shards of rack k of region r, as (shard, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> "Tree":
        """So many regions of so many racks of so many shards, all of weight 1."""
        return cls(tuple(tuple(tuple(((r * racks + k) * shards + s, 1.0) for s in range(shards))
                               for k in range(racks)) for r in range(regions)))

    def shards(self) -> list[int]:
        return [s for racks in self.regions for rack in racks for s, _ in rack]

    def grown(self, weight: float = 1.0) -> "Tree":
        """The tree with one more shard, in a new region."""
        return Tree((*self.regions, (((max(self.shards()) + 1, weight),),)))

    def reweighted(self, shard: int, weight: float) -> "Tree":
        return Tree(tuple(tuple(tuple((s, weight if s == shard else w) for s, w in rack) for rack in racks) for racks in self.regions))


def _weight(node) -> float:
    return node[1] if isinstance(node[0], int) else sum(map(_weight, node))


def _literal(node, name: str) -> Column:
    """A node as a struct of name, weight and children (a shard: its number)."""
    head = [F.lit(name).alias("name"), F.lit(float(_weight(node))).alias("weight")]
    if isinstance(node[0], int):
        return F.struct(*head, F.lit(node[0]).alias("shard"))
    return F.struct(*head, _children(node, name).alias("children"))


def _children(nodes: Sequence, name: str) -> Column:
    return F.array(*(_literal(n, f"{name}/{n[0] if isinstance(n[0], int) else k}") for k, n in enumerate(nodes)))


def _drawn(children: Column, key: Column) -> Column:
    """The child with the least weighted draw; its name decides a tie."""
    def draw(child: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + 1) / F.lit(float(1 << 53))
        return F.struct((-F.log(unit) / child["weight"]).alias("draw"), child["name"].alias("name"), child.alias("child"))

    return F.array_min(F.transform(children, draw))["child"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that ``key`` descends to."""
    region = _drawn(_children(tree.regions, "root"), key)
    rack = _drawn(region["children"], key)
    return _drawn(rack["children"], key)["shard"]


def place(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``slot`` numbers the rows of a shard without gaps. Rows are dealt into
    ``SLOT_BUCKETS`` buckets a shard by a hash of id and text; buckets are
    counted, their running sums (one row a bucket, however long the table)
    broadcast, and rows numbered within their bucket.
    """
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    placed = cut(docs.select(
        ident.alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(ident, tree).alias("shard"), shard_of(ident, tree.grown()).alias("grown_shard"),
        F.xxhash64(ident, text).alias("tie")).withColumn("bucket", F.pmod("tie", F.lit(SLOT_BUCKETS)).cast("int")))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "tie")
    return (placed.join(F.broadcast(starts), ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("start") + F.row_number().over(within) - 1).alias("slot"), "grown_shard"))
