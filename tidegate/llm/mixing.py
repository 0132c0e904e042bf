"""Mixing sources to target weights by entropy balancing.

Entropy balancing keeps document rates as near as it can to 1: it minimises the
sum of r log r - r over documents such that each source's expected tokens meet
its target and no rate is above the cap. The convex dual has one multiplier per
source, and its solution tilts documents exponentially: r = min(cap,
exp(multiplier * size)), sizes taken relative to their source's mean. A source
that must grow repeats long documents first, one that must shrink parts with
them first, which moves the fewest documents away from rate 1. The dual has no
closed form; Newton's method, kept within a bracket of the root, solves all
sources at once. Each step is one distributed sum over cells (source, size) of
the tilted tokens (gradient) and their slopes (Hessian, diagonal as constraints
are of single sources). Multipliers live in a table; nothing of a source passes
through the driver.

Rates become whole copies size by size, largest first: each cell takes the
whole number of copies nearest to its tokens plus what larger sizes left over,
and hash order decides which of a cell's equally long documents get one more. A
source ends within half its smallest documents of the target, save where its
documents are too few for that.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, packed, salted_rank, table

#: Weights by rank of source, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-9


def size_of(text: Column) -> Column:
    """Words divided by ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row: rows that share both are taken as equal. Columns that can't be hashed count as JSON."""
    plain = [F.col(f"`{c}`") if not re.search("map<|variant", t) else F.to_json(F.struct(F.col(f"`{c}`"))) for c, t in df.dtypes]
    return [F.xxhash64(F.lit(seed), *plain).alias(name) for seed, name in ((1, "hash1"), (2, "hash2"))]


def source_key(source: Column) -> Column:
    """Keys in code point order of sources, null last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def targets(totals: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """totals (key, total, ...) with target: ``share`` of all, by weight, none above ``cap`` times its own.

    Weights follow the order of keys. What a full source can't take is shared
    among the others by weight, until none is above: sources are full below one
    level of cap * total / weight, which rises to its place in a few sums.
    """
    # ranks: within ranges of keys, then over the ranges, which are few
    parted = scratch.keep(totals.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    named = parted.join(F.broadcast(starts), "part").withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))).drop("part", "start")
    named = scratch.keep(named)
    scratch.drop(parted)
    full = F.col("total") * cap
    level, everything = None, None
    while True:
        over = F.lit(False) if level is None else full < F.col("weight") * level
        capped, free, total = named.agg(F.sum(F.when(over, full)), F.sum(F.when(~over, F.col("weight"))), F.sum("total")).first()
        everything = share * (total or 0)
        now = (everything - (capped or 0.0)) / free if free else math.inf
        if now == level or not free:
            break
        if level is not None and now < level:  # rounding; the level only rises
            break
        level = now
    return named.withColumn("target", F.least(full, F.col("weight") * F.lit(math.inf if level is None else now)))


def solve_rates(cells: DataFrame, goals: DataFrame, scratch: Scratch, cap: float = CAP, most: int = 200) -> DataFrame:
    """goals (key, total, docs, target, ...) with lam, the multiplier of each source's relative size.

    cells: (key, size, n). Newton's steps on all sources that aren't solved yet;
    a step that leaves the bracket of the root is replaced by bisection, or by
    doubling while one side is open. A source whose target is its cap, or that
    has no tokens, needs no multiplier: infinity stands for the cap.
    """
    mean = F.col("total") / F.greatest("docs", F.lit(1))
    easy = (F.col("total") == 0) | (F.col("target") >= F.col("total") * cap * (1 - 1e-12))
    state = goals.withColumn("mean", F.greatest(mean, F.lit(1e-300))).withColumn("lam", F.when(easy, math.inf).otherwise(0.0))
    state = scratch.keep(state.withColumn("lo", F.lit(-math.inf)).withColumn("hi", F.lit(math.inf)).withColumn("done", easy))
    lam, x = F.col("lam"), F.col("size") / F.col("mean")
    for _ in range(most):
        if state.where("not done").isEmpty():
            return state
        tilt = F.exp(F.least(lam * x, F.lit(math.log(cap))))
        at = cells.where("size > 0").join(state.where("not done").select("key", "lam", "mean"), "key")
        sums = at.groupBy("key").agg(F.sum(F.col("n") * x * tilt).alias("tokens"), F.sum(F.when(lam * x < math.log(cap), F.col("n") * x * x * tilt).otherwise(0.0)).alias("slope"))
        f = F.col("tokens") - F.col("target") / F.col("mean")
        lo, hi = F.when(f < 0, lam).otherwise(F.col("lo")), F.when(f > 0, lam).otherwise(F.col("hi"))
        newton = lam - f / F.nullif("slope", F.lit(0.0))
        step = F.abs(lam) + 1
        otherwise = F.when(lo == -math.inf, lam - step).when(hi == math.inf, lam + step).otherwise((lo + hi) / 2)
        # from afar a flat slope leads too far: no step is longer than doubling
        good = newton.isNotNull() & (newton > lo) & (newton < hi) & (F.abs(newton - lam) <= 8 * step)
        solved = F.abs(f) <= TOLERANCE * F.col("target") / F.col("mean")
        stuck = (lo != -math.inf) & (hi != math.inf) & (hi - lo <= 1e-15 * step)
        old = ["key", *[c for c in state.columns if c not in ("key", "lam", "lo", "hi", "done")]]
        go = state.join(sums, "key", "left")
        open_ = ~F.col("done") & F.col("tokens").isNotNull()
        new = go.select(
            *old,
            F.when(open_ & ~solved & ~stuck, F.when(good, newton).otherwise(otherwise)).otherwise(lam).alias("lam"),
            F.when(open_, lo).otherwise(F.col("lo")).alias("lo"),
            F.when(open_, hi).otherwise(F.col("hi")).alias("hi"),
            (~open_ | solved | stuck).alias("done"),
        )
        last, state = state, scratch.keep(new)
        scratch.drop(last)
    raise RuntimeError(f"the dual was not solved in {most} steps")


def rate_of(size: Column, cap: float = CAP) -> Column:
    """A document's rate by its size and its source's lam and mean."""
    return F.when(F.col("lam") == math.inf, F.lit(cap)).otherwise(F.exp(F.least(F.col("lam") * size / F.col("mean"), F.lit(math.log(cap)))))


def _round_source(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies for each size of one source, largest first, carrying what is over."""
    cells = cells.sort_values("size", ascending=False)
    carry, copies = 0.0, []
    for size, n, rate, most in zip(cells["size"], cells["n"], cells["rate"], cells["most"], strict=True):
        if not size:
            copies.append(0)
            continue
        want = rate * n * size + carry
        m = int(min(max(math.floor(want / size + 0.5), 0), most * n))
        copies.append(m)
        carry = want - m * size
    return pd.DataFrame({"key": cells["key"], "size": cells["size"], "n": cells["n"], "rate": cells["rate"], "m": copies})


def mix(df: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", sized: DataFrame | None = None) -> DataFrame:
    """Rows as struct ``row``, with size, source_size, target, rate and copies (0 to ``cap``).

    Null and empty texts have size 0 and no copies. A null source is a source of
    its own, last in order. Repeated rows are rounded each on its own; rows that share an id
    or have none are told apart by all their columns, so that reruns agree in any order of rows. An empty
    table gives an empty one. Other columns are carried along untouched,
    whatever their names. ``cap`` must be a whole number.
    """
    rows = sized if sized is not None else df.select(packed(df).alias("row"), F.col(f"`{id_col}`").alias("id"), source_key(F.col(f"`{source_col}`")).alias("key"), size_of(F.col(f"`{text_col}`")).alias("size"), *row_hashes(df))
    cells = scratch.keep(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = cells.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("total"), F.coalesce(F.sum(F.when(F.col("size") > 0, F.col("n"))), F.lit(0)).alias("docs"))
    of_source = solve_rates(cells, targets(totals, scratch, weights, share, cap), scratch, cap)
    # one row per source and distinct size, however many documents
    m = cells.join(of_source.select("key", "mean", "lam"), "key").select("key", "size", "n", rate_of(F.col("size"), cap).alias("rate"), F.lit(int(cap)).alias("most"))
    m = m.groupBy("key").applyInPandas(_round_source, "key string, size long, n long, rate double, m long")
    m = scratch.keep(m.join(of_source.select("key", F.col("total").alias("source_size"), "target"), "key"))
    # by id first, then by all of the row: whatever the order of rows, the same texts get the copies
    ranked = salted_rank(rows, ["key", "size"], [F.xxhash64("id"), F.col("id"), F.col("hash1"), F.col("hash2")], F.xxhash64("id", F.lit("salt"), "hash1"), "rank", 64, m)
    copies = (F.expr("m div n") + F.when(F.col("rank") < F.expr("m % n"), 1).otherwise(0)).cast("int")
    return ranked.select("row", "size", "source_size", "target", "rate", copies.alias("copies"))


def mixed_rows(df: DataFrame, scratch: Scratch, **how) -> DataFrame:
    """The mixed rows themselves, each as often as it has copies."""
    out = mix(df, scratch, **how).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "mixing")
    docs = table(spark, sf_dir, "documents")
    sized = scratch.keep(docs.select(F.struct("doc_id").alias("row"), F.col("doc_id").alias("id"), source_key(F.col("source")).alias("key"), size_of(F.col("text")).alias("size"), *row_hashes(docs)))
    out = mix(docs, scratch, sized=sized)
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate")


ORACLE = None
