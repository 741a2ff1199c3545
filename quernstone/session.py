"""Session set-up and lineage cutting."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from quernstone.errors import EngineError

#: Settings the engine relies on; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}

_written: list[tuple[SparkSession, str]] = []


def session(app: str = "quernstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent (single-machine tests) a temporary folder is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise EngineError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quernstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again.

    The written table ends the lineage, so a lost executor never triggers more than the work after
    it, and it is columnar, so later steps read only the columns they need. The files are removed
    when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone already
            continue


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors' Python workers, once per application."""
    import os
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quernstone-"), "quernstone_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if not f.endswith(".pyc"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def spread(df: DataFrame, rows_per_task: int, least: int | None = None) -> DataFrame:
    """A written ``df`` over as many tasks as its rows need, and at least the cluster's cores.

    For Python stages whose input is few bytes but much work: an explicit number keeps AQE from
    merging the partitions again.
    """
    cores = least or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows_per_task)))
