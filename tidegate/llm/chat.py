"""Chat formatting with cumulative-snapshot collapse.

A service that logs a conversation after every turn logs the same turns again
and again. Each conversation's turns get rolling hashes of the prefix that
ends with them; a conversation whose whole is a proper prefix of another's is a
snapshot and goes, by an anti-join on the hashes. What is left is rendered.

Prefix hashes are running exclusive-ors of hashes keyed by a turn's rank in its
conversation, computed within segments of turns and carried across them, so that
a conversation of any length is dealt over many tasks. Rendering goes by ranges of
messages in order, with counts and bytes carried across ranges: a row of text is
bounded, however many messages a turn has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import Scratch, table

#: Turn numbers of one segment, and messages of one row of rendered text.
SEGMENT = 1024
#: A row of rendered text ends with the message that brings it past a multiple of so many bytes.
BYTES = 4 << 20
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rendered(role: Column, text: Column) -> Column:
    """One message; the template's own marks inside a message lose their bar."""
    plain = lambda c: F.replace(c, F.lit("<|im_"), F.lit("<im_"))
    return F.concat(F.lit(OPEN), plain(role), F.lit("\n"), plain(text), F.lit(CLOSE + "\n"))


def _before(key: list[str], order: str):
    return Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def collapse(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(messages, maximal): all distinct messages with key and place; and the conversations that stay, with copies.

    Columns conv_id, turn, role, text. A null role is "unknown", a null text
    empty, a null conv_id a conversation of its own, a null turn comes before
    all others. Turns count by their order, not their numbers: 1, 2 may be a
    prefix of 0, 1, 2. A message that repeats in full within its conversation
    counts once. Messages of one turn stand in order of role and text. Of equal
    conversations the smallest conv_id stays, null last.
    """
    m = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    # a key that no id has stands for none
    m = m.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("none"))).withColumn("at", F.coalesce("turn", F.lit(-(2**62)))).drop("turn")
    m = scratch.keep(m)
    x = F.bit_xor
    part = F.expr(f"floor(at / {SEGMENT}L)").alias("part")
    per_turn = m.groupBy("key", "conv_id", part, "at").agg(F.count(F.lit(1)).alias("n"), x(F.xxhash64("role", "text")).alias("a"), x(F.xxhash64(F.lit("second"), "text", "role")).alias("b"))
    per_turn = scratch.keep(per_turn)
    # one row per conversation and segment
    sizes = per_turn.groupBy("key", "part").agg(F.count(F.lit(1)).alias("turns"))
    sizes = sizes.select("key", "part", F.coalesce(F.sum("turns").over(_before(["key"], "part")), F.lit(0)).alias("earlier"), F.sum("turns").over(Window.partitionBy("key")).alias("of"))
    rank = F.row_number().over(Window.partitionBy("key", "part").orderBy("at")) + F.col("earlier")
    ranked = per_turn.join(sizes, ["key", "part"]).withColumn("rank", rank)
    ranked = ranked.withColumn("a", F.xxhash64("rank", "n", "a", "b")).withColumn("b", F.xxhash64(F.lit("second"), "b", "n", "rank"))
    ranked = scratch.keep(ranked.select("key", "conv_id", "part", "rank", (F.col("rank") == F.col("of")).alias("full"), "n", "a", "b"))
    within = Window.partitionBy("key", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    before = _before(["key"], "part")
    parts = ranked.groupBy("key", "part").agg(F.sum("n").alias("pn"), x("a").alias("pa"), x("b").alias("pb"))
    carried = parts.select("key", "part", F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("cn"), F.coalesce(x("pa").over(before), F.lit(0)).alias("ca"), F.coalesce(x("pb").over(before), F.lit(0)).alias("cb"))
    run = ranked.select("key", "conv_id", "part", "full", F.sum("n").over(within).alias("n"), x("a").over(within).alias("a"), x("b").over(within).alias("b")).join(carried, ["key", "part"])
    prefix = run.select("key", "conv_id", (F.col("n") + F.col("cn")).alias("n"), F.col("a").bitwiseXOR(F.col("ca")).alias("a"), F.col("b").bitwiseXOR(F.col("cb")).alias("b"), "full")
    prefix = scratch.keep(prefix)
    # common first turns and equal conversations shrink to one row before they meet
    proper = prefix.where("not full").select("n", "a", "b").distinct()
    full = prefix.where("full").groupBy("n", "a", "b").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "key")).alias("c"), F.count(F.lit(1)).alias("copies"))
    left = full.join(proper, ["n", "a", "b"], "left_anti").select("c.key", "n", "copies")
    return m, left


def chat(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Maximal conversations rendered: conv_id, part, n_messages, copies, text.

    One row per SEGMENT messages or BYTES bytes of a conversation (most have
    one row), parts in order from 0. copies: how many logged conversations were
    this very one. Extra columns aren't read; an empty table gives an empty one.
    """
    m, left = collapse(turns, scratch)
    left = scratch.keep(left)
    kept = m.join(left.select("key", "copies"), "key").select("key", "conv_id", "copies", "at", "role", "text", F.octet_length("text").alias("size"))
    order = ["at", "role", "text"]
    # messages are distinct, so that ranges part even a turn of many
    kept = scratch.keep(kept.repartitionByRange("key", *order).withColumn("range", F.spark_partition_id()))
    here = Window.partitionBy("key", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per conversation and range
    sums = kept.groupBy("key", "range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    earlier = _before(["key"], "range")
    sums = sums.select("key", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size0"))
    placed = kept.withColumn("n1", F.count(F.lit(1)).over(here)).withColumn("size1", F.coalesce(F.sum("size").over(here), F.lit(0))).join(sums, ["key", "range"])
    no = F.col("n0") + F.col("n1")
    placed = placed.withColumn("no", no).withColumn("seg", F.struct(F.floor(no / SEGMENT).alias("by_count"), F.floor((F.col("size0") + F.col("size1")) / BYTES).alias("by_size")))
    one = F.struct("no", rendered(F.col("role"), F.col("text")).alias("message"))
    texts = placed.groupBy("key", "conv_id", "copies", "seg").agg(F.count(F.lit(1)).alias("n_messages"), F.array_sort(F.collect_list(one)).alias("all"))
    texts = scratch.keep(texts.select("key", "conv_id", "copies", "seg", "n_messages", F.array_join("all.message", "").alias("text")))
    # numbers of segments: one narrow row for each
    number = (F.row_number().over(Window.partitionBy("key").orderBy("seg")) - 1).cast("long").alias("part")
    return texts.join(texts.select("key", "seg", number), ["key", "seg"]).select("conv_id", "part", "n_messages", "copies", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat(table(spark, sf_dir, "conversations"), Scratch(spark, "chat"))


ORACLE = """
WITH m AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), r AS (
  SELECT conv_id, turn, role, text, '<|im_start|>' || replace(role, '<|im_', '<im_') || chr(10) || replace(text, '<|im_', '<im_') || '<|im_end|>' || chr(10) AS message FROM m
), t AS (
  SELECT conv_id, turn, count(*) AS n, string_agg(chr(1) || role || chr(2) || text || chr(3), '' ORDER BY role, text) || chr(4) AS s FROM r GROUP BY conv_id, turn
), p AS (
  SELECT conv_id, turn, string_agg(s, '') OVER w AS s, turn IS NOT DISTINCT FROM last_value(turn) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS is_full
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS UNBOUNDED PRECEDING)
), f AS (SELECT s, min(conv_id) AS c, count(*) AS copies FROM p WHERE is_full GROUP BY s),
k AS (SELECT c, copies FROM f WHERE s NOT IN (SELECT s FROM p WHERE NOT is_full))
SELECT k.c AS conv_id, 0::BIGINT AS part, count(*) AS n_messages, copies, string_agg(message, '' ORDER BY turn NULLS FIRST, role, text) AS text
FROM k JOIN r ON r.conv_id IS NOT DISTINCT FROM k.c GROUP BY k.c, copies
"""
