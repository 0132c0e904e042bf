"""A Merkle manifest of a dataset: a leaf digest a row, a tree a group, one root over the groups' subroots.

Where a leaf hangs follows from its exact rank in its group. Ranks come without a
global sort: a row's key is a string of digits, rows are counted by a long prefix
of it, and counts are added up by ever shorter prefixes, some hex digits a step.
Going down again, a prefix begins where its smaller siblings end. A window holds
the children of one prefix, a million at most. Only within one prefix are rows
sorted, 4,096 different ids at most. Prefixes with too many rows, as of a repeated or null id, are split on
by the digits of leaf and row.

A rank's digits to base 8 are the leaf's way through the tree: nodes are keyed by
ranks without their last digits, and leaves with equal longest prefixes are
reduced together. Three digits go at a time: up to 512 nodes of one prefix are
gathered in a row, and its levels are worked out there, so a billion leaves take
four shuffles, each a five-hundredth of the one before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import Scratch, ascii_lower, table

FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
#: Levels worked out in one row, of FANOUT ** STRIDE nodes.
STRIDE = 3
STRIDE_BITS = FANOUT_BITS * STRIDE
#: Rows of one prefix that are sorted together.
MOST = 8192
#: Digits of a row's id, of its leaf and of its serial number in a long key.
ID, LEAF, SERIAL = 16, 6, 6


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts as one text."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def encoded(c: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; null as a dash."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[encoded(v) for v in values])


def id_digits(c: Column) -> Column:
    """16 characters of an integer that sort as it does; null's come first."""
    return F.coalesce(F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), ID, "0"), F.lit("-" * ID))


def group_digits(c: Column) -> Column:
    """A group's name as text that is never null, sorts by bytes, and null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def begins(counts: DataFrame, lengths: list[int], at: DataFrame) -> DataFrame:
    """Adds ``base`` to rows (g, prefix, n): how many rows of g have smaller prefixes.

    Prefixes have ``lengths[0]`` characters; the others, descending, are those of the levels
    above. ``at`` has (g, top, base): where each prefix of the last of the lengths begins.
    """
    levels = [counts]
    for n in lengths[1:]:
        levels.append(levels[-1].groupBy("g", F.substring("prefix", 1, n).alias("prefix")).agg(F.sum("n").alias("n")))
    for level, n in zip(reversed(levels[:-1]), reversed(lengths[1:]), strict=True):
        w = Window.partitionBy("g", "top").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("top", F.substring("prefix", 1, n))
        own = own.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
        at = own.join(at.select("g", "top", "base"), ["g", "top"]).select("g", F.col("prefix").alias("top"), "n", (F.col("base") + F.col("before")).alias("base"))
    return at.withColumnRenamed("top", "prefix")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("g", "prefix").agg(F.count(F.lit(1)).alias("n"))


def _ranked_within(rows: DataFrame, order: list[str]) -> DataFrame:
    w = Window.partitionBy("g", "prefix").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w) - 1 + F.col("base")).drop("base", "n", "prefix")


def ranked(rows: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """Adds ``rank``, from 0 in each g, to rows with g, key (``id_digits``), leaf and serial, in order of key and leaf.

    ``rows`` must be a written table, as it is read more than once. Equal key and
    leaf: any order, as such rows don't differ.
    """
    short = [13, 9, 5, 0]
    rows = rows.withColumn("prefix", F.substring("key", 1, short[0]))
    counts = scratch.keep(_counted(rows))
    zero = counts.select("g").distinct().select("g", F.lit("").alias("top"), F.lit(0).cast("long").alias("base"))
    base = scratch.keep(begins(counts, short, zero))
    known = rows.join(base, ["g", "prefix"])
    light = _ranked_within(known.where(F.col("n") <= most), ["key", "leaf"])
    heavy = base.where(F.col("n") > most)
    if heavy.isEmpty():
        return light
    long = F.concat("key", F.substring("leaf", 1, LEAF), F.substring(F.md5(F.col("serial").cast("string")), 1, SERIAL))
    dense = known.where(F.col("n") > most).drop("n", "base").withColumn("prefix", long)
    counts = scratch.keep(_counted(dense))
    base = scratch.keep(begins(counts, [ID + LEAF + SERIAL, 24, 20, 16, short[0]], heavy.select("g", F.col("prefix").alias("top"), "base")))
    return light.unionByName(_ranked_within(dense.join(base, ["g", "prefix"]), ["key", "leaf"]))


def ranked_groups(groups: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """Adds ``rank`` to rows of distinct ``name``, by its bytes; prefixes are as short as leaves at most ``most`` rows each."""
    named = scratch.keep(groups.withColumn("key", F.hex(F.encode("name", "UTF-8"))))
    n = 0
    while (named.groupBy(F.substring("key", 1, n)).count().agg(F.max("count")).first()[0] or 0) > most:
        n += 2
    rows = named.withColumn("g", F.lit("")).withColumn("prefix", F.substring("key", 1, n))
    at = scratch.keep(_counted(rows))
    zero = scratch.spark.createDataFrame([("", "", 0)], "g string, top string, base long")
    base = begins(at, list(range(n, -1, -2)), zero) if n else at.withColumn("base", F.lit(0).cast("long"))
    return _ranked_within(rows.join(base.select("g", "prefix", "base"), ["g", "prefix"]), ["key"]).drop("g", "key")


def _reduced(nodes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int")), lambda j: digest(F.array_join(F.slice(nodes, j * FANOUT + 1, FANOUT), "")))


def _left(n: Column, level: int) -> Column:
    """How many of n nodes are left after so many levels."""
    return F.ceil(n / FANOUT**level)


def _strided(nodes: DataFrame, scratch: Scratch, *carried: str) -> DataFrame:
    """One row per (g, rank without its last digits): up to 512 nodes in order, the levels above them, and ``node``, what they become.

    ``nodes`` has g, n (how many nodes g has), rank, node, and further columns to carry along.
    """
    gathered = nodes.groupBy("g", "n", F.shiftright("rank", STRIDE_BITS).alias("idx")).agg(F.sort_array(F.collect_list(F.struct("rank", "node", *carried))).alias("each"))
    t = gathered.select("g", "n", "idx", F.col("each")["node"].alias("level0"), F.transform("each", lambda x: F.struct(*[x[c].alias(c) for c in ("rank", *carried)])).alias("own"))
    for k in range(STRIDE):
        up = F.when(_left(F.col("n"), k) > 1, _reduced(F.col(f"level{k}"))).otherwise(F.col(f"level{k}"))
        t = t.withColumn(f"level{k + 1}", up)
    return scratch.keep(t.withColumn("node", F.get(f"level{STRIDE}", F.lit(0))).drop(f"level{STRIDE}"))


def _reach(nodes: DataFrame, scratch: Scratch, most: int, *carried: str) -> list[DataFrame]:
    """Strides from the nodes up to one node in each g, of at most ``most`` nodes."""
    out = [_strided(nodes, scratch, *carried)]
    while most > 1 << STRIDE_BITS:
        most = -(-most >> STRIDE_BITS)
        out.append(_strided(out[-1].select("g", _left(F.col("n"), STRIDE).alias("n"), F.col("idx").alias("rank"), "node"), scratch))
    return out


def _beside(nodes: Column, p: Column) -> Column:
    """The siblings of the node at p, before and after it in its run."""
    d = p % FANOUT
    left = F.array_join(F.slice(nodes, p - d + 1, d), "")
    return F.struct(left.alias("left"), F.array_join(F.slice(nodes, p + 2, FANOUT - 1 - d), "").alias("right"))


def _descend(stride: DataFrame, above: DataFrame) -> DataFrame:
    """One row per node of the stride: g, ``own`` with its rank and what it carries, node, path from it to the root, and what ``above`` tells of its g.

    ``above`` has g, idx, path and further columns.
    """
    none = F.array().cast("array<struct<left:string,right:string>>")

    def steps(p: Column) -> Column:
        own = [F.when(_left(F.col("n"), k) > 1, F.array(_beside(F.col(f"level{k}"), F.shiftright(p, FANOUT_BITS * k)))).otherwise(none) for k in range(STRIDE)]
        return F.concat(*own, F.col("path"))

    rest = [c for c in above.columns if c not in ("g", "idx", "path")]
    each = F.transform("own", lambda o, p: F.struct(o.alias("own"), F.get("level0", p).alias("node"), steps(p).alias("path")))
    return stride.drop("node").join(above, ["g", "idx"]).select("g", *rest, F.inline(each).alias("own", "node", "path"))


@dataclass
class Manifest:
    """A dataset's tree. ``groups``: one row per group, its name, n, subroot and root. Tables live as long as their scratch folder."""

    strides: list[DataFrame]
    groups: DataFrame
    top: DataFrame

    def proofs(self) -> DataFrame:
        """One row per leaf: ``own`` (rank and what was carried), leaf, subroot, root, and path: siblings left and right of it, level by level up to the root."""
        at = self.top.withColumn("idx", F.lit(0).cast("long"))
        for s in reversed(self.strides[1:]):
            at = _descend(s, at).select("g", F.col("own.rank").alias("idx"), "path", "subroot", "root")
        return _descend(self.strides[0], at).withColumnRenamed("node", "leaf")


def build(leaves: DataFrame, scratch: Scratch, carried: list[str], most: int = MOST) -> Manifest:
    """The tree over rows (g, key, leaf) and what they carry; g from ``group_digits``, key from ``id_digits``.

    Rows with equal keys are leaves of their own, in order of their digests. Null
    ids come first. No rows: no groups, no proofs. A group or an id may hold any share of
    the rows: no task needs more than some thousand of them.
    """
    rows = scratch.keep(leaves.withColumn("serial", F.monotonically_increasing_id()))
    ranks = ranked(rows, scratch, most)
    sizes = scratch.keep(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    largest, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = ranks.join(sizes, "g").select("g", "n", "rank", F.col("leaf").alias("node"), *carried)
    strides = _reach(nodes, scratch, largest or 0, *carried)
    subroots = strides[-1].select(F.col("g").alias("name"), "node")
    named = ranked_groups(subroots, scratch, most).select(F.lit("").alias("g"), F.lit(groups).cast("long").alias("n"), "rank", "node", "name")
    over = _reach(named, scratch, groups, "name")
    none = F.array().cast("array<struct<left:string,right:string>>")
    at = over[-1].select("g", F.lit(0).cast("long").alias("idx"), none.alias("path"), F.col("node").alias("root"))
    for s in reversed(over[1:]):
        at = _descend(s, at).select("g", F.col("own.rank").alias("idx"), "path", "root")
    top = scratch.keep(_descend(over[0], at).select(F.col("own.name").alias("g"), "path", F.col("node").alias("subroot"), "root"))
    return Manifest(strides, top.join(sizes, "g").select(F.col("g").alias("name"), "n", "subroot", "root"), top)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives by its path."""
    return F.aggregate(path, leaf, lambda at, s: digest(s["left"], at, s["right"]))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


#: What a leaf of documents digests, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(df: DataFrame, scratch: Scratch, most: int = MOST) -> Manifest:
    """The manifest of documents by lang. Leaves carry doc_id and ``tampered``, the leaf of the row with its text's A-Z lower-cased.

    tampered is null but where 3 divides crc32 of the decimal doc_id; a null id
    is never tampered. Any column may be null, texts of any length, rows repeated. Columns
    besides the five aren't read.
    """
    lowered = [F.col(c) if c != "text" else ascii_lower(F.col(c)) for c in FIELDS]
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    leaves = df.select(
        group_digits(F.col("lang")).alias("g"), id_digits(F.col("doc_id")).alias("key"), "doc_id", leaf_of(*[F.col(c) for c in FIELDS]).alias("leaf"), F.when(chosen, leaf_of(*lowered)).alias("tampered")
    )
    return build(leaves, scratch, ["doc_id", "tampered"], most)


def checked(df: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    p = manifest(df, scratch, most).proofs()
    root = folded(F.coalesce(F.col("own.tampered"), F.col("leaf")), F.col("path"))
    out = p.select(F.col("own.doc_id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(table(spark, sf_dir, "documents"), Scratch(spark, "merkle"))


_LEAF = "sha256(" + " || ".join("coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')".format(c) for c in FIELDS) + ")"
_LEFT, _RIGHT = "array_to_string(nodes[p - p % 8 + 1 : p], '')", "array_to_string(nodes[p + 2 : p - p % 8 + 8], '')"

# DuckDB has no crc32(): as in the SQL of sharding.
ORACLE = f"""
WITH RECURSIVE tab AS (
  SELECT i, list_reduce(list_concat([i::BIGINT], [0,0,0,0,0,0,0,0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) r(i)
), bytes AS (SELECT list(v ORDER BY i) AS a FROM tab),
d AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda s, b: xor(s >> 8, a[1 + xor(s & 255, b)])), 4294967295) % 3 = 0 AS hit
  FROM documents, bytes
), l AS (
  SELECT doc_id, lang, {_LEAF} AS leaf,
    CASE WHEN hit THEN {_LEAF.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM d
), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM l),
t AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY r) AS nodes FROM r GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], ''))) FROM t WHERE len(nodes) > 1
), s AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS r FROM t WHERE len(nodes) = 1),
u AS (
  SELECT 0 AS lvl, list(subroot ORDER BY r) AS nodes FROM s
  UNION ALL
  SELECT lvl + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], ''))) FROM u WHERE len(nodes) > 1
), below AS (
  SELECT lang, r, list({_LEFT} || '|' || {_RIGHT} ORDER BY lvl) AS steps FROM (SELECT r.lang, r.r, t.lvl, t.nodes, r.r >> (3 * t.lvl) AS p FROM r JOIN t ON r.lang IS NOT DISTINCT FROM t.lang AND len(t.nodes) > 1) GROUP BY ALL
), above AS (
  SELECT lang, list({_LEFT} || '|' || {_RIGHT} ORDER BY lvl) AS steps FROM (SELECT s.lang, u.lvl, u.nodes, s.r >> (3 * u.lvl) AS p FROM s JOIN u ON len(u.nodes) > 1) GROUP BY ALL
), x AS (
  SELECT r.*, s.subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root, list_concat(coalesce(b.steps, []::VARCHAR[]), coalesce(o.steps, []::VARCHAR[])) AS steps
  FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang LEFT JOIN below b ON r.lang IS NOT DISTINCT FROM b.lang AND r.r = b.r LEFT JOIN above o ON r.lang IS NOT DISTINCT FROM o.lang
), f AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
    list_reduce(list_concat([coalesce(tampered, leaf)], steps), lambda h, e: sha256(split_part(e, '|', 1) || h || split_part(e, '|', 2))) AS folded_root
  FROM x
)
SELECT *, folded_root = root AS verified FROM f
"""
