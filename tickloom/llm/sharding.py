"""Assigning rows to shards by a hierarchical weighted hash tree.

Method: the tree has regions, racks and shards, each with a weight (a node weighs what its
shards weigh). A row descends from the root: at each level every child draws ln(u) / weight,
u being a hash of the row's id and the child's name, and the largest draw wins. A child's draw
depends on the row, its name and its weight only, so changing a weight moves rows into or out
of that child's subtree and leaves all others where they are.

Growing adds a region of its own with one rack and one shard: at the root nothing but the new
child's draw is new, so rows move into the new shard only (law `key`).

Slots number the rows of a shard without gaps. Rows are numbered inside cells of a bounded
expected size (a hash of the id; the cell count follows the row count), and only the cells'
counts are added up along a shard; no task holds a shard.

Defined cases: a null text has size 1 and the checksum of an empty text; a null id is hashed
as an empty one; repeated rows share a shard and have slots of their own; an empty table gives
an empty result; further columns are ignored. Rows of equal text are not kept together: the
id alone decides.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: (region, rack, shard number, weight)
Leaf = tuple[str, str, int, float]

CELL_ROWS = 20_000          # rows that one numbering cell should hold


def balanced_tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """Shards of equal weight, filled up rack by rack and region by region."""
    return [(f"region{i // (per_rack * racks)}", f"rack{i // per_rack}", i, 1.0) for i in range(shards)]


def grown_tree(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    new = max((leaf[2] for leaf in tree), default=-1) + 1
    return [*tree, (f"region+{new}", f"rack+{new}", new, weight)]


def _children(tree: Sequence[Leaf]) -> dict[str, list[dict]]:
    """Each node's children by name with their weights; a node is named by its path."""
    weights: dict[str, dict[str, float]] = {}
    for region, rack, shard, weight in tree:
        if weight > 0:
            path = [region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            for parent, child in zip(["", *path], path):
                of = weights.setdefault(parent, {})
                of[child] = of.get(child, 0.0) + weight
    if not weights:
        raise ValueError("the tree has no shard with a weight")
    return {p: [{"name": c, "weight": w} for c, w in of.items()] for p, of in weights.items()}


def descend(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard that `key` reaches: three draws, from the root to a shard. Equal draws go to
    the larger name."""
    nodes = F.from_json(F.lit(json.dumps(_children(tree))), "map<string,array<struct<name:string,weight:double>>>")

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11).cast("double")
        return F.struct((F.log((bits + 0.5) / float(1 << 53)) / child["weight"]).alias("draw"), child["name"].alias("name"))

    at = F.lit("")
    for _ in range(3):
        at = F.array_max(F.transform(F.element_at(nodes, at), draw))["name"]
    return F.substring_index(at, "/", -1).cast("int")


def assign(docs: DataFrame, tree: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text",
           grown: Sequence[Leaf] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = rows.withColumns({"shard": descend(key, tree), "grown_shard": descend(key, grown or grown_tree(tree))})
    # The number of rows decides how many cells a shard needs; a count reads no column.
    cells = max(1, -(-docs.count() // (CELL_ROWS * len(tree))))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64(key, F.lit("cell")), F.lit(cells)).cast("int"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    counts = placed.groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = placed.withColumn("rn", F.row_number().over(within)).join(offsets, ["shard", "cell"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                           (F.col("rn") - 1 + F.col("before")).cast("long").alias("slot"), "grown_shard")
