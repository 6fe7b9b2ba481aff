"""Sharding by a hierarchical weighted hash tree.

A row descends from the root through regions and racks to a shard. On each
level every child of the node reached draws a number from the hash of the key
and the child's path, -ln(u) / weight, and the least draw wins, so a child wins
in proportion to its weight. A child's draws depend on nothing but its own path
and weight: if one weight changes, rows move into or out of that child's
subtree alone, and draws below the other children stay as they are.

All of it is column expressions; a row meets only the children on its way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, numbered, written

#: {region: {rack: {shard: weight}}}; names are unique among siblings, shards in the tree.
Tree = dict[str, dict[str, dict[int, float]]]

REGIONS, RACKS, SHARDS = 2, 3, 4


def tree(shards: int) -> Tree:
    """The tree of ``shards`` shards of weight 1.

    The first 24 (fewer for small counts) fill 2 regions of 3 racks of 4; each
    later shard opens a region of its own. One more shard thus changes the
    weight of no other subtree and takes rows only into itself.
    """
    out: Tree = {}
    full = REGIONS * RACKS * SHARDS
    for s in range(shards):
        if shards >= full and s < full:
            region, rack = f"g{s // (RACKS * SHARDS)}", f"r{s // SHARDS % RACKS}"
        else:
            region, rack = f"x{s}", "r0"
        out.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return out


def _total(node) -> float:
    return sum(map(_total, node.values())) if isinstance(node, dict) else float(node)


def _children(level: dict[str, dict]) -> Column:
    """Map from a node's path to its children: array of (name, weight)."""
    entries = []
    for path, node in level.items():
        kids = [F.struct(F.lit(str(name)).alias("name"), F.lit(_total(kid)).alias("weight"))
                for name, kid in node.items() if _total(kid) > 0]
        entries += [F.lit(path), F.array(*kids)]
    return F.create_map(*entries)


def _drawn(children: Column, path: Column, key: Column) -> Column:
    """The path of the child that draws least; equal draws: the least name."""
    def draw(child: Column) -> Column:
        digest = F.md5(F.concat(key, F.lit("|"), path, F.lit("/"), child["name"]).cast("binary"))
        u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))
    return F.concat(path, F.lit("/"), F.array_min(F.transform(children, draw))["name"])


def assign(rows: DataFrame, key: str, shards: Tree, into: str) -> DataFrame:
    """``rows`` with the shard (int) of string column ``key``; a null key is the empty one."""
    levels = [{"": shards}]
    levels.append({f"/{a}": x for a, x in shards.items()})
    levels.append({f"/{a}/{b}": y for a, x in shards.items() for b, y in x.items()})
    value, path = F.coalesce(F.col(key), F.lit("")), F.lit("")
    name = f"_{into}_path"
    rows = rows.withColumn(name, path)
    for level in levels:
        rows = rows.withColumn(name, _drawn(F.element_at(_children(level), F.col(name)), F.col(name), value))
    return rows.withColumn(into, F.substring_index(name, "/", -1).cast("int")).drop(name)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Every row of ``docs`` with its shard, its slot there, and its shard if there were one more.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard). The key is the
    doc_id, so the law is ``key``; rows that repeat a doc_id share a shard and
    so do all null ids. Null texts are empty. Slots follow (doc_id, crc32,
    size), nulls last, without gaps from 0. An empty table gives an empty result.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("k"),
                       docs["doc_id"].cast("string").alias("key"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = assign(assign(rows, "key", tree(shards), "shard"), "key", tree(shards + 1), "grown_shard")
    rows = numbered(written(rows.drop("key"), "shards"), "shard", ["k", "text_crc32", "size"], "slot")
    return rows.select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "size", "text_crc32",
                       F.lit("key").alias("law"), "shard", "slot", "grown_shard")
