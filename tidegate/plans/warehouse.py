"""The warehouse: immutable Parquet folders, and manifests that name them.

A commit writes new folders first and then the next version's manifest, under a
name that only one writer can take, so all tables change together or not at all,
and of two writers that began from one version the second is refused. A reader
that resolved a manifest keeps its snapshot. Daily counts are kept by month: an
upsert rewrites only the months that it touches, all in one job, and with them the
venues' days of these months, from which a run plans without reading counts.
Rejects are kept by month too, and read only of those that a run rejects of. Works on any
Hadoop file system whose rename refuses a name that is taken.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate import schema
from tidegate.operators.frontier import days_by_month
from tidegate.operators.gate import reject_month
from tidegate.operators.merge import upsert

MANIFESTS, STAGING = "_manifests", "_staging"


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the snapshot that a change is based on."""


def utc_now():
    """Wall time in UTC without a zone, as stored."""
    from datetime import UTC, datetime

    return datetime.now(UTC).replace(tzinfo=None)


@dataclass
class Commit:
    """What a commit changes; a table left None stays.

    batch: a stream's id and the number of the micro-batch whose rows these are.
    The manifest keeps each stream's last number, so a batch that has been
    committed changes nothing when it comes again.
    """

    pageviews: DataFrame | None = None
    quarantine: DataFrame | None = None
    watermark: DataFrame | None = None
    run_log: list[tuple] = field(default_factory=list)
    batch: tuple[str, int] | None = None


class Warehouse:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        if not self._versions():
            try:
                self._publish({"version": 0, "pageviews": {}, "quarantine": [], "watermark": [], "run_log": []})
            except ConcurrentCommit:
                pass  # another has just made it

    # files

    def _jvm_path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._jvm_path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._fs().exists(self._jvm_path(name))

    def _versions(self) -> list[str]:
        """Names of manifests, oldest first."""
        if not self._exists(MANIFESTS):
            return []
        return sorted(n for s in self._fs().listStatus(self._jvm_path(MANIFESTS)) if (n := s.getPath().getName()).startswith("v"))

    def manifest(self) -> dict:
        stream = self._fs().open(self._jvm_path(f"{MANIFESTS}/{self._versions()[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """The commit point: a rename to the version's name, refused if it is taken."""
        jvm = self.spark._jvm
        new = self._jvm_path(f"{MANIFESTS}/_{uuid.uuid4().hex}")
        out = self._fs().create(new, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        name = self._jvm_path(f"{MANIFESTS}/v{manifest['version']:012d}")
        try:
            context.rename(new, name, how)
        except Exception as e:
            if not self._fs().exists(name):
                raise
            self._fs().delete(new, False)
            raise ConcurrentCommit(f"version {manifest['version']} of {self.path} is another writer's") from e

    def _write(self, df: DataFrame, table: str) -> str:
        name = f"{table}/{uuid.uuid4().hex}"
        rows = df.select([F.col(f.name).cast(f.dataType) for f in schema.TABLES[table]])
        if table == "quarantine":
            self._write_by(reject_month(F.col("view_date")), rows, name)
        else:
            rows.write.parquet(f"{self.path}/{name}")
        return name

    def _write_by(self, month: Column, rows: DataFrame, name: str) -> None:
        """A folder with one of each month; a month's rows over several files where they are many, and not a file of each task."""
        self._dealt(month, rows).drop("part").write.partitionBy("month").parquet(f"{self.path}/{name}")

    def _dealt(self, month: Column, rows: DataFrame) -> DataFrame:
        return rows.withColumn("month", month).withColumn("part", F.pmod(F.xxhash64("venue_id"), F.lit(8))).repartition("month", "part")

    def _months_of(self, name: str) -> list[str]:
        """The folders of months in a folder."""
        return sorted(f"{name}/{n}" for s in self._fs().listStatus(self._jvm_path(name)) if (n := s.getPath().getName()).startswith("month="))

    # reading

    def read(self, table: str, manifest: dict | None = None, months: list[str] | None = None) -> DataFrame:
        """A table of the current snapshot, or of ``manifest``; columns that old folders lack are null.

        months: only those of daily counts, or of rejects, whose old folders, with
        rows of any month, are always read.
        """
        names = (manifest or self.manifest())[table]
        if table == "pageviews":
            names = [n for m, n in names.items() if months is None or m in months]
        elif table == "quarantine" and months is not None:
            names = [n for n in names if "/month=" not in n or n.rsplit("/month=", 1)[1] in months]
        return self._folders(names, schema.TABLES[table])

    def _folders(self, names: list[str], kind: StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/{n}" for n in names])

    def history(self, manifest: dict | None = None) -> DataFrame:
        """``days_by_month`` of all daily counts, as each commit has left it. Counts are read only of months whose commit left none."""
        m = manifest or self.manifest()
        kept = {month: days for month, (counts, days) in m.get("history", {}).items() if m["pageviews"].get(month) == counts}
        known = self._folders([*kept.values()], schema.HISTORY)
        rest = [month for month in m["pageviews"] if month not in kept]
        return known.unionByName(days_by_month(self.read("pageviews", m, rest))) if rest else known

    # writing

    def committed(self, batch: tuple[str, int], manifest: dict | None = None) -> bool:
        """Whether a stream's batch, or a later one, has been committed."""
        return (manifest or self.manifest()).get("streams", {}).get(batch[0], -1) >= batch[1]

    def commit(self, change: Commit, base: dict | None = None, most: int = 5) -> None:
        """All of a change, or on any error none of it. A stream's batch that stands already is left out.

        base: the manifest that the change was worked out from; it must still be
        the latest, else ConcurrentCommit. Without one the change holds whatever
        others have written, and is tried again upon the latest.
        """
        for left in reversed(range(most)):
            now = base or self.manifest()
            if base and self.manifest()["version"] != base["version"]:
                raise ConcurrentCommit(f"{self.path} has changed since version {base['version']}")
            if change.batch and self.committed(change.batch, now):
                return None
            try:
                return self._publish(self._changed(now, change))
            except ConcurrentCommit:
                if base or not left:
                    raise

    def _changed(self, now: dict, change: Commit) -> dict:
        """The next manifest, its new folders written."""
        new = json.loads(json.dumps(now))
        if change.pageviews is not None:
            counts = self._write_months(now, change.pageviews)
            new["pageviews"].update(counts)
            new["history"] = {**new.get("history", {}), **self._write_history(counts)}
        if change.quarantine is not None:
            new["quarantine"] += self._months_of(self._write(change.quarantine, "quarantine"))
        if change.watermark is not None:
            new["watermark"] = [self._write(upsert(self.read("watermark", now), change.watermark, ["venue_id"]), "watermark")]
        if change.run_log:
            rows = self.spark.createDataFrame(change.run_log, schema.RUN_LOG)
            if len(new["run_log"]) < 32:
                again = {r[0] for r in change.run_log} & {r[0] for r in self.read("run_log", now).select("run_id").where(F.col("run_id").isin([r[0] for r in change.run_log])).collect()}
            else:
                again = {""}  # time to write one folder again
            if again:
                new["run_log"] = [self._write(upsert(self.read("run_log", now), rows, ["run_id"]).coalesce(1), "run_log")]
            else:
                new["run_log"].append(self._write(rows.coalesce(1), "run_log"))
        if change.batch:
            new["streams"] = {**new.get("streams", {}), change.batch[0]: change.batch[1]}
        new["version"] += 1
        return new

    def _write_months(self, now: dict, rows: DataFrame) -> dict[str, str]:
        """Folders by month of the months that rows touch, in one job however many."""
        month = F.date_format("view_date", "yyyy-MM")
        touched = [r[0] for r in rows.select(month).distinct().collect()]  # one row a month
        merged = upsert(self.read("pageviews", now, touched), rows, ["venue_id", "view_date"])
        name = f"pageviews/{uuid.uuid4().hex}"
        self._write_by(month, merged.select([F.col(f.name).cast(f.dataType) for f in schema.TABLES["pageviews"]]), name)
        return {m: f"{name}/month={m}" for m in touched}

    def _write_history(self, counts: dict[str, str]) -> dict[str, list[str]]:
        """By month, the folder of counts and that of its venues' days."""
        if not counts:
            return {}
        name = f"history/{uuid.uuid4().hex}"
        written = self._folders([*counts.values()], schema.TABLES["pageviews"]).select("venue_id", "view_date")
        # dealt as counts are, and summed up where they lie: one shuffle
        days = days_by_month(self._dealt(F.date_format("view_date", "yyyy-MM"), written), "month", "part")
        days.drop("part").write.partitionBy("month").parquet(f"{self.path}/{name}")
        return {m: [folder, f"{name}/month={m}"] for m, folder in counts.items()}

    def compact(self, table: str = "quarantine") -> None:
        """An append-only table's folders as one."""
        m = self.manifest()
        name = self._write(self.read(table, m), table)
        m[table] = self._months_of(name) if table == "quarantine" else [name]
        m["version"] += 1
        self._publish(m)

    def vacuum(self) -> int:
        """Deletes folders that the latest manifest doesn't name, older manifests, and what broken runs have staged.

        Only when no one reads older snapshots or writes. Returns how many folders went.
        """
        m, fs, gone = self.manifest(), self._fs(), 0
        named = {**{t: m[t] for t in schema.TABLES}, "pageviews": m["pageviews"].values(), "history": [days for _, days in m.get("history", {}).values()]}
        for table, names in named.items():
            used = set(names)
            used |= {n.rsplit("/month=", 1)[0] for n in used}
            if self._exists(table):
                for s in fs.listStatus(self._jvm_path(table)):
                    name = f"{table}/{s.getPath().getName()}"
                    if name not in used:
                        gone += fs.delete(s.getPath(), True)
                    elif table in ("pageviews", "history"):
                        for month in fs.listStatus(s.getPath()):
                            if month.isDirectory() and f"{name}/{month.getPath().getName()}" not in used:
                                gone += fs.delete(month.getPath(), True)
        for old in self._versions()[:-1]:
            fs.delete(self._jvm_path(f"{MANIFESTS}/{old}"), False)
        if self._exists(STAGING):
            fs.delete(self._jvm_path(STAGING), True)
        return gone

    def stage(self, df: DataFrame, run: str, step: str) -> DataFrame:
        """A run's table, written once, as a source must not be asked twice; unstage() deletes all of a run's."""
        path = f"{self.path}/{STAGING}/{run}/{step}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_counted(self, df: DataFrame, run: str, step: str, **counts: Column) -> tuple[DataFrame, dict]:
        """stage(), and aggregates of its rows by name, observed by the tasks that write them: no job of their own.

        They are taken in the writing stage, where a task that is run again counts once.
        """
        seen = Observation()
        return self.stage(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), run, step), seen.get

    def unstage(self, run: str) -> None:
        if self._exists(f"{STAGING}/{run}"):
            self._fs().delete(self._jvm_path(f"{STAGING}/{run}"), True)
