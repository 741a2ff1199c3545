"""Checks of delivered tables; each is one aggregate and they union into one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _report(df: DataFrame, check: str, ok: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), ok.alias("ok"), detail.cast("string").alias("detail"))


def unique(df: DataFrame, key: str, check: str) -> DataFrame:
    """Passes if no key repeats; the detail is the number of surplus rows. Repeats are counted per key, so no task holds all keys."""
    over = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return _report(over, check, F.col("n") == 0, F.col("n"))


def row_count(df: DataFrame, expected: int, check: str) -> DataFrame:
    return _report(df.agg(F.count("*").alias("n")), check, F.col("n") == expected, F.col("n"))


def not_null(df: DataFrame, columns: list[str], prefix: str = "not null: ") -> DataFrame:
    """One row a column; the detail is the number of nulls. All columns are counted in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    items = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns)))
    return counts.select(items.alias("x")).select(F.concat(F.lit(prefix), F.col("x.c")).alias("check"), (F.col("x.n") == 0).alias("ok"), F.col("x.n").cast("string").alias("detail"))


def in_domain(df: DataFrame, column: str, allowed: list[str], check: str) -> DataFrame:
    """Passes if every value that is there is allowed; null is no value."""
    n = F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
    return _report(df.agg(n.alias("n")), check, F.col("n") == 0, F.col("n"))


def refers(df: DataFrame, ref: Column, parents: DataFrame, key: str, check: str) -> DataFrame:
    """Passes if every reference that is there is a key of ``parents``; the detail is the number of those that are not."""
    p = parents.select(F.col(key).alias("p_key")).where("p_key is not null").distinct()
    lost = df.select(ref.alias("r")).where("r is not null").groupBy("r").agg(F.count("*").alias("n")).join(p, F.col("r") == F.col("p_key"), "left_anti")
    return _report(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), check, F.col("n") == 0, F.col("n"))


def uncovered(names: DataFrame, name: str, known: DataFrame, key: str, alternatives: list[Column]) -> DataFrame:
    """Names of which no alternative form is known: (name)."""
    forms = names.select(F.col(name).alias("n")).where("n is not null").distinct().withColumn("form", F.explode(F.array_distinct(F.array(*alternatives))))
    k = known.select(F.col(key).alias("form")).where("form is not null").distinct()
    hit = forms.join(k, "form", "left_semi").select(F.col("n").alias("hit")).distinct()
    return forms.select("n").distinct().join(hit, F.col("n") == F.col("hit"), "left_anti").select(F.col("n").alias(name))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
