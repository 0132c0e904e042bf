"""The session that the engine expects: UTC, and JSON objects whose last repeated key wins."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}


def get_spark(app: str = "tidegate", **settings: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship_code(spark)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Bounds by bytes what Python gets at once, before whole texts go there: 10,000 rows may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, unless they find it as the driver does.

    They do if its folder is on PYTHONPATH or the working folder, or if it came
    by --py-files. Done once a context.
    """
    import atexit
    import os
    import shutil
    import tempfile
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    known = {os.path.realpath(p) for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()] if p}
    if not root.is_dir() or str(root) in known or getattr(sc, "_tidegate_shipped", False):
        return
    # the driver's own, which serves it to executors until it ends
    made = tempfile.mkdtemp(prefix="tidegate-code-")
    atexit.register(shutil.rmtree, made, True)
    name = Path(made) / "tidegate.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.glob("tidegate/**/*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(name))
    sc._tidegate_shipped = True
