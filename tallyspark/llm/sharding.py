"""Hierarchical weighted hash tree: region, rack and shard are drawn level by level.

At a node every child c draws ``-ln(u) / weight(c)``, where u in (0, 1) is a hash of the key and the
child's path and weight(c) the sum of its shards' weights; the smallest draw wins (a child's chance is
its share of the weight, ties go to the smaller path).  A draw depends on nothing but key, path and the
child's own weight, so a changed weight moves rows only into or out of the subtrees whose weight changed.
No state, no shuffle: placement is an expression on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, written

Tree = dict[str, dict[str, dict[str, float]]]  # region -> rack -> shard -> weight


def grown_tree(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Shards 0 to ``shards`` - 1 of weight 1, filled rack by rack, region by region."""
    tree: Tree = {}
    for s in range(shards):
        region, rack = s // (per_rack * racks), s // per_rack % racks
        tree.setdefault(str(region), {}).setdefault(str(rack), {})[str(s)] = 1.0
    return tree


def children(tree: Tree) -> dict[str, list[tuple[str, float]]]:
    """Path of each inner node ('' is the root) to its children's paths and weights; weights of 0 drop out."""
    out: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in sorted(tree.items()):
        total = 0.0
        for rack, shards in sorted(racks.items()):
            if any(w < 0 for w in shards.values()):
                raise ValueError("a weight is negative")
            at, weight = f"{region}/{rack}", sum(shards.values())
            if weight > 0:
                out.setdefault(region, []).append((at, weight))
                out[at] = [(f"{at}/{s}", float(w)) for s, w in sorted(shards.items()) if w > 0]
            total += weight
        if total > 0:
            out[""].append((region, total))
    if not out[""]:
        raise ValueError("the tree has no shard of positive weight")
    return out


def draw(key: Column, path: Column, weight: Column) -> Column:
    """-ln(u) / weight, u from the top 53 bits of the hash of 'key|path'."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("|", key, path)), 11)
    return -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def place(key: Column, tree: Tree) -> Column:
    """Path 'region/rack/shard' of a key's shard.  The tree is a literal of the plan, one map look-up a level;
    a key costs as many draws as the nodes on its way have children.  A null key is drawn as the text 'null'."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    pairs = [x for parent, kids in children(tree).items() for x in (
        F.lit(parent), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(w).alias("weight")) for p, w in kids]))]
    kids, at = F.create_map(*pairs), F.lit("")
    for _ in range(3):
        at = F.array_min(F.transform(kids[at], lambda c: F.struct(
            draw(key, c["path"], c["weight"]).alias("draw"), c["path"].alias("path"))))["path"]
    return at


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Deal ``docs`` (doc_id, text; other columns are left out) into ``shards`` shards by doc_id.

    One row per input row: doc_id, size (UTF-8 bytes of the text plus 1; a null text has none),
    text_crc32 (of the UTF-8 text; 0 for null or empty), law 'key', region, rack, shard, slot (gapless
    from 0 in each shard, also over repeated rows) and grown_shard, the shard once one more is added.
    An empty table gives an empty result.  The new shard takes rows only into itself if it opens a
    region of its own, which ``grown_tree`` does whenever the regions so far are full, as with 8.
    """
    leaf = lambda path, i: F.split(path, "/")[i].cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        place(F.col("doc_id"), grown_tree(shards)).alias("old"), place(F.col("doc_id"), grown_tree(shards + 1)).alias("new"))
    placed = written(placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), leaf(F.col("old"), 0).alias("region"),
        leaf(F.col("old"), 1).alias("rack"), leaf(F.col("old"), 2).alias("shard"), leaf(F.col("new"), 2).alias("grown_shard")), "placed")
    return numbered(placed, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")
