"""Shared helpers: scratch tables, salted ranks and prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Spark has no A-Z-only lower(); translate() leaves every other letter alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local (tests) a temporary
    folder is made and put into the session's setting.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tidegate-")
    _delete_on_exit(spark, made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


class Scratch:
    """Tables written to the shared folder to cut lineage.

    They survive the loss of executors, and being files they have known sizes,
    so that Spark broadcasts one only if it is under the session's threshold.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        _delete_on_exit(spark, self.root)

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables no longer needed (also from a loop's earlier rounds)."""
        for t in tables:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def clear(self) -> None:
        """Deletes all of its tables."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def bound_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def spread(df: DataFrame) -> DataFrame:
    """Rows of fewer files than there are cores, dealt over all cores: one small file is one task, however much its rows cost."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores // 2 else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, *but: str) -> Column:
    """A row's columns, ``but`` some, as one struct, out of the way of an operator's own names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in but] or [F.lit(True).alias("none")])


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def likely_in(df: DataFrame, col: str, ids: DataFrame, bits: int = 23) -> DataFrame:
    """Rows of ``df`` whose ``col`` may be among ``ids`` (one column): a Bloom filter before a join.

    Drops most rows that the join would drop, before they are shuffled. The
    filter is a bitmap of 2^bits bits, whatever the number of ids, so its
    broadcast has a fixed size (1 MB); full of ids it drops less. Null goes.
    """
    h = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(1 << bits))
    b, m = "bucket__", "bitmap__"
    at = ids.select(h(ids.columns[0]).alias("h"))
    maps = at.groupBy(F.bitmap_bucket_number("h").alias(b)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias(m))
    pos = F.bitmap_bit_position(h(col))
    byte = F.conv(F.hex(F.substr(F.col(m), (F.floor(pos / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1, cast({'bitmap_bit_position(pmod(xxhash64(`' + col + '`), ' + str(1 << bits) + 'L))'} % 8 as int))"))
    return df.where(F.col(col).isNotNull()).join(F.broadcast(maps), F.bitmap_bucket_number(h(col)) == F.col(b)).where(bit != 0).select(*df.columns)


def salted_rank(
    df: DataFrame, keys: list[str], order: list[Column], salt_of: Column, out: str, salts: int = 256, of_key: DataFrame | None = None
) -> DataFrame:
    """Adds ``out``: a rank from 0, without gaps, within equal ``keys``; and the columns of ``of_key``, a frame by keys.

    A key is split into ``salts`` parts by ``salt_of``; each part is ranked on
    its own and begins where the parts before it end. So no task needs all rows
    of a key, and only ``salts`` counts per key are shuffled besides the rows.
    Keys and salt must not be null.
    """
    s, at, before = "salt__", "at__", "before__"
    parted = df.withColumn(s, F.pmod(salt_of, F.lit(salts)).cast("int"))
    counts = parted.groupBy(*keys, s).agg(F.count(F.lit(1)).alias(before))
    w = Window.partitionBy(*keys).orderBy(s).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(w), F.lit(0)))
    if of_key is not None:
        counts = counts.join(of_key, keys)
    ranked = parted.withColumn(at, F.row_number().over(Window.partitionBy(*keys, s).orderBy(*order)) - 1)
    both = ranked.join(counts, [*keys, s]).withColumn(out, (F.col(at) + F.col(before)).cast("long"))
    return both.drop(s, at, before)
