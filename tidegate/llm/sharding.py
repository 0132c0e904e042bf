"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard. At each level every child draws
-ln(u)/weight, u a hash of the document's key and the child's name, and the
smallest draw wins; a child's chance is its share of the weight, a node's weight
the sum of its shards'. Draws of one child don't depend on others, so where
weights change, a row moves only out of or into a subtree whose weight has
changed, at the level where it has: between two subtrees that keep theirs, and
within them, no row moves.

A shard is added as a region of its own. Its draw competes at the top level
only, so rows go into the new shard or stay: no row moves between old shards.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import salted_rank, table

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def tree(shards: int, per_rack: int = 2, racks: int = 3) -> Tree:
    """An even tree of shards 0 to ``shards`` - 1, all of weight 1."""
    out: Tree = {}
    for s in range(shards):
        r = s // per_rack
        out.setdefault(f"region{r // racks}", {}).setdefault(f"rack{r}", {})[s] = 1.0
    return out


def grow(old: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    n = 1 + max(s for racks in old.values() for shards in racks.values() for s in shards)
    return {**old, f"region-of-{n}": {f"rack-of-{n}": {n: weight}}}


def shard_of(key: Column, t: Tree) -> Column:
    """The shard of a string key. Children of weight 0 get nothing; a tree needs some weight.

    Equal draws: the first child. The tree is a constant of the plan, a map from
    node to children, so the plan doesn't grow with the shards.
    """
    nodes: dict[str, list[tuple[str, float, str]]] = {}
    for region, racks in t.items():
        for rack, shards in racks.items():
            leaves = [(f"shard{s}", float(w), str(s)) for s, w in shards.items() if w > 0]
            if leaves:
                nodes[f"/{region}/{rack}"] = leaves
                nodes.setdefault(f"/{region}", []).append((rack, sum(w for _, w, _ in leaves), f"/{region}/{rack}"))
        if f"/{region}" in nodes:
            nodes.setdefault("", []).append((region, sum(w for _, w, _ in nodes[f"/{region}"]), f"/{region}"))
    if not nodes:
        raise ValueError("the tree has no weight")
    children = F.from_json(F.lit(json.dumps({k: [{"name": n, "weight": w, "child": c} for n, w, c in v] for k, v in nodes.items()})), "map<string,array<struct<name:string,weight:double,child:string>>>")

    def draw(c: Column, i: Column) -> Column:
        h = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), c["name"])), 1, 13), 16, 10).cast("double")
        return F.struct((-F.log((h + 0.5) / float(2**52)) / c["weight"]).alias("draw"), i.alias("i"), c["child"].alias("child"))

    node = F.lit("")
    for _ in ("region", "rack", "shard"):
        node = F.array_min(F.transform(F.element_at(children, node), draw))["child"]
    return node.cast("int")


def shard(df: DataFrame, t: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, law, shard, slot, grown_shard; with ``carry`` also struct ``row``, the row itself.

    size: UTF-8 bytes of the text plus 8; a null text has 0 bytes and the CRC of
    none. slot counts a shard's rows from 0 without gaps. Ids are integers. A
    null id is a key of its own, "null"; repeated rows fall into the same shard, in slots of
    their own. Other columns aren't read unless carried; an empty table gives an
    empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *([F.struct(*df.columns).alias("row")] if carry else []))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    new = shard_of(key, grown) if grown else F.lit(None).cast("int")
    rows = rows.withColumn("shard", F.coalesce(shard_of(key, t), F.lit(-1))).withColumn("grown_shard", new)
    ranked = salted_rank(rows, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.coalesce(F.col("doc_id"), F.col("text_crc32")), "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", *(["row"] if carry else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tree(24)
    return shard(table(spark, sf_dir, "documents"), t, grow(t))


def _sql(t: Tree) -> str:
    """The shard of doc_id as DuckDB SQL."""

    def pick(children: list[tuple[str, float, str]]) -> str:
        if len(children) == 1:
            return children[0][2]
        draws = ", ".join(f"{{'d': -ln((('0x' || md5(k || '/{n}')[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / {w}::DOUBLE, 'i': {i}}}" for i, (n, w, _) in enumerate(children))
        return f"CASE list_min([{draws}]).i " + " ".join(f"WHEN {i} THEN {v}" for i, (_, _, v) in enumerate(children)) + " END"

    return pick([(region, sum(sum(s.values()) for s in racks.values()), pick([(rack, sum(s.values()), pick([(f"shard{n}", w, str(n)) for n, w in s.items()])) for rack, s in racks.items()])) for region, racks in t.items()])


# DuckDB has no crc32(): 8 steps a byte would be a query of its own, so the CRC
# is left to tests and the SQL takes it from a table of remainders.
ORACLE = f"""
WITH RECURSIVE tab AS (
  SELECT i, list_reduce(list_concat([i::BIGINT], [0,0,0,0,0,0,0,0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) r(i)
), t AS (SELECT list(v ORDER BY i) AS a FROM tab),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, coalesce(text, '') AS x FROM documents),
c AS (
  SELECT doc_id, k, strlen(x) + 8 AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(rtrim(regexp_replace(hex(encode(x)), '(..)', '\\1 ', 'g')), ' '), lambda h: CASE WHEN h = '' THEN -1 ELSE ('0x' || h)::BIGINT END)),
      lambda s, b: CASE WHEN b < 0 THEN s ELSE xor(s >> 8, a[1 + xor(s & 255, b)]) END), 4294967295) AS text_crc32
  FROM d, t
), s AS (SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, ({_sql(tree(24))})::INT AS shard, ({_sql(grow(tree(24)))})::INT AS grown_shard FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY ((coalesce(doc_id, text_crc32) % 256) + 256) % 256, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM s
"""
