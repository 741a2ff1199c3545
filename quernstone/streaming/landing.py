"""Structured Streaming over a landing folder: the import's operators on rows as they arrive."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernstone.operators import dedup


def landed(spark: SparkSession, folder: str, schema: str, format: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    """A stream of the files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(format).load(folder)


def fresh(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """The first row of every key within the watermark; state of older keys is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def arrivals(stream: DataFrame, time: str, by: list[str], window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows per window of arrival; rows later than the watermark are not counted any more."""
    counts = stream.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), *by, "n")


def into(stream: DataFrame, existing: str, out: str, checkpoint: str, key: str = "iri", policy: str = "skip") -> StreamingQuery:
    """Appends each batch's new identifiers to ``out``: first-wins in the batch, then the policy against ``existing`` and ``out``.

    Each batch goes to a folder of its own, so a repeated batch replaces itself.
    """

    def batch(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        rows = dedup.first_wins(df.withColumn("ord", F.struct(*(F.col(c) for c in df.columns if c != key))), [key], "ord").drop("ord")
        old = spark.read.parquet(existing).select(key)
        before = [str(p) for p in sorted(Path(out).glob("batch=*")) if p.name != f"batch={n}"]
        if before:
            old = old.unionByName(spark.read.parquet(*before).select(key))
        dedup.against(rows, old, policy, key).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
