"""Column kinds of free-form rows, over all rows: the strongest kind that a column shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Precedence of kinds.
RANK = {"list": 5, "string": 4, "double": 3, "bigint": 2, "boolean": 1, "null": 0}
TYPES = {"list": T.ArrayType(T.StringType()), "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "null": T.StringType()}


def json_kinds(df: DataFrame, column: str, order: str) -> DataFrame:
    """(name, kind, first_seen) of the keys of JSON objects: the strongest kind of any row; keys that are always null are strings."""
    pairs = df.where(F.col(column).isNotNull()).select(order, F.explode(F.from_json(column, "map<string,string>")).alias("name", "value"))
    kind = (
        F.when(F.col("value").isNull(), "null").when(F.startswith("value", F.lit("[")), "list").when(F.col("value").isin("true", "false"), "boolean")
        .when(F.col("value").rlike(r"^-?\d+$"), "bigint").when(F.col("value").rlike(r"^-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), "double").otherwise("string")
    )
    rank = F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))
    found = pairs.withColumn("kind", kind).groupBy("name").agg(F.max(F.struct(rank[F.col("kind")].alias("r"), F.col("kind").alias("k"))).alias("best"), F.min(order).alias("first_seen"))
    strongest = F.when(F.col("best.k") == "null", "string").otherwise(F.col("best.k"))
    return found.select("name", strongest.alias("kind"), "first_seen")


def schema(kinds: DataFrame) -> T.StructType:
    """A schema in order of first sight; keys are few by nature."""
    return T.StructType([T.StructField(r["name"], TYPES[r["kind"]]) for r in kinds.orderBy("first_seen", "name").collect()])


def _kind(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    return {list: "list", tuple: "list", float: "double", int: "bigint"}.get(type(v), "string")


def record_schema(records: list[dict]) -> T.StructType:
    """A schema for the rows of a small document, columns in order of first sight."""
    best: dict[str, str] = {}
    for r in records:
        for k, v in r.items():
            kind = _kind(v)
            best[k] = max(best.get(k, "null"), kind, key=RANK.__getitem__)
    return T.StructType([T.StructField(k, TYPES[v]) for k, v in best.items()])
