"""Sharding by a hierarchical weighted hash tree (regions, racks, shards).

A key descends the tree: at every level each child of the current node makes
a weighted hash draw, ``-ln(u) / weight`` with ``u`` from a hash of the key,
the level and the child, and the smallest draw wins. A child's share is its
weight's share, and a draw depends on nothing but the key, the child and that
child's weight. Changing the weight of one shard changes the draws of that
shard, its rack and its region only, so rows move only into (or out of) the
subtrees whose weights change; two untouched subtrees never exchange rows.

Everything is built from DataFrame expressions; the tree is a literal.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewise.llm.common import stage

#: Production layout of the registered query.
PLANNED_SHARDS = 24
RACKS_PER_REGION = 2
SHARDS_PER_RACK = 4
#: Numbering cells per shard; a cell is what one task sorts to number rows.
CELLS = 4096
#: Bytes that every document counts besides its text.
ROW_OVERHEAD = 8


class Leaf(NamedTuple):
    """One shard and its place; a weight of 0 takes no rows."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, planned: int = PLANNED_SHARDS, racks: int = RACKS_PER_REGION,
           per_rack: int = SHARDS_PER_RACK) -> list[Leaf]:
    """Equal-weight tree of ``shards`` shards.

    The ``planned`` shards fill racks, and racks fill regions. Every shard
    past the plan opens a region of its own: no other node's weight changes
    then, so from ``planned`` shards on, one more shard takes rows only into
    itself.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    base = [Leaf(s // (racks * per_rack), s // per_rack, s) for s in range(min(shards, planned))]
    last = base[-1]
    return base + [Leaf(last.region + i, last.rack + i, planned + i - 1) for i in range(1, shards - len(base) + 1)]


def _children(weights: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("node"), F.lit(float(w)).alias("weight"))
                     for n, w in sorted(weights.items())])


def _draw(key: Column, level: str, children: Column) -> Column:
    """Node of the child with the smallest weighted draw (ties: smallest node)."""
    def one(child):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child["node"]), 11)
        uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(uniform) / child["weight"]).alias("draw"), child["node"].alias("node"))

    return F.array_min(F.transform(children, one))["node"]


def descend(key: Column, tree: Sequence[Leaf]) -> tuple[Column, Column, Column]:
    """(region, rack, shard) of a key; a null key descends like any other value."""
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    shards: dict[int, dict[int, float]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            regions[leaf.region] = regions.get(leaf.region, 0.0) + leaf.weight
            in_region = racks.setdefault(leaf.region, {})
            in_region[leaf.rack] = in_region.get(leaf.rack, 0.0) + leaf.weight
            shards.setdefault(leaf.rack, {})[leaf.shard] = leaf.weight
    if not regions:
        raise ValueError("the tree has no shard with a positive weight")

    def of(parent: Column, children: dict[int, dict[int, float]]) -> Column:
        pairs = [x for node, inner in sorted(children.items()) for x in (F.lit(node), _children(inner))]
        return F.element_at(F.create_map(*pairs), parent)

    region = _draw(key, "region", _children(regions))
    rack = _draw(key, "rack", of(region, racks))
    return region, rack, _draw(key, "shard", of(rack, shards))


def assign(docs: DataFrame, tree: Sequence[Leaf], grown: Sequence[Leaf], id_col: str = "doc_id",
           text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Place every row in a shard of ``tree`` and number the rows of a shard.

    Returns doc_id, size (UTF-8 bytes of the text, 0 for null, plus 8),
    text_crc32, law 'key', shard, slot, grown_shard (the shard in ``grown``),
    region and rack. Slots run from 0 without gaps in each shard: rows are
    numbered inside hash cells of the shard, and a cell starts where the cells
    before it end, so no task holds a whole shard. Rows that repeat id and
    text share a cell and get neighbouring slots; a null id is one key.
    """
    key = F.col(f"`{id_col}`")
    text = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    read = docs.select(key.alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    region, rack, shard = descend(F.col("doc_id"), tree)
    grown_shard = descend(F.col("doc_id"), grown)[2]
    cell = F.pmod(F.xxhash64("doc_id", "text_crc32", "size", F.lit("cell")), F.lit(cells)).cast("int")
    placed = stage(read.select("*", region.alias("region"), rack.alias("rack"), shard.alias("shard"),
                               grown_shard.alias("grown_shard"), cell.alias("cell")), "shards")
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = (Window.partitionBy("shard").orderBy("cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("nth", F.row_number().over(inside))
            .join(starts, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard", "region", "rack"))
