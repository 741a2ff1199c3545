"""Stable order and contiguous shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_key(df: DataFrame) -> F.Column:
    """notation, else iri, else ''; columns that are not there are passed over."""
    parts = [F.when(F.col(c) != "", F.col(c)) for c in ("notation", "iri") if c in df.columns]
    return F.coalesce(*parts, F.lit(""))


def positions(df: DataFrame, keys: list[F.Column], name: str = "row_no") -> DataFrame:
    """``df`` with its rank from 1 in the total order of ``keys`` (which must be unique).

    A global window would put all rows in one task. The rows are ordered into ranges instead,
    numbered within their range, and moved by the sizes of the ranges before.
    """
    from quernstone.session import cut

    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = cut(df.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()))
    sizes = laid.groupBy("part").agg(F.count("*").alias("size"))  # one row a partition
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size")
    return laid.join(F.broadcast(before), "part").withColumn(name, F.row_number().over(Window.partitionBy("part").orderBy(*keys)) + F.col("before")).drop("part", "before")


def shards(df: DataFrame, keys: list[F.Column], n: int, name: str = "shard") -> DataFrame:
    """``df`` with the number from 1 of its contiguous shard: ``n`` slices of ceil(rows / n) rows, the last one shorter."""
    placed = positions(df, keys, "row_no")
    size = -(-placed.count() // n) or 1
    return placed.withColumn(name, F.floor((F.col("row_no") - 1) / size).cast("int") + 1)
