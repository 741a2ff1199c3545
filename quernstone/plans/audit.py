"""Checks over the staged output of the inventory family, as one DataFrame (check, ok, detail)."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text
from quernstone.functions.routing import SECTORS
from quernstone.operators import checks

#: Domains and limits of the staged tables.
FLOW_TYPES = ["production", "technosphere", "biosphere"]
DIRECTIONS = ["input", "output"]
PROCESS_TYPES = ["unit", "system", "lci_result"]
REQUIRED = ["name", "reference_product", "reference_unit", "location"]
MOST_MB = 50
METADATA_KEYS = {"sector", "title", "description", "rank", "schema_version", "row_counts"}


def _told(spark: SparkSession, rows: list[tuple[str, bool, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "check string, ok boolean, detail string")


def _coverage(processes: DataFrame, products: DataFrame) -> DataFrame:
    """Products ``name - location`` of a results workbook that no process has, also under the workbook's own location names."""
    have = processes.select(F.concat_ws(" - ", "name", "location").alias("form"))
    wanted = products.select(text.repaired("product").alias("product")).where("product is not null")
    n = F.col("n")
    relabelled = [F.regexp_replace(n, " - US-([^-]*)$", " - $1"), F.regexp_replace(n, " - RER without CH$", " - Europe without Switzerland")]
    lost = checks.uncovered(wanted, "product", have, "form", [n, *relabelled])
    return lost.agg(F.count("*").alias("n")).select(F.lit("workbook products are covered").alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))


def audit(spark: SparkSession, root: Path, expected: int | None = None, products: DataFrame | None = None) -> DataFrame:
    """All checks of ``root``/inventory and ``root``/vocab.

    expected: number of datasets. products: (product) names of a results workbook.
    """
    inventory, told = root / "inventory", []
    files: dict[str, list[str]] = {"processes": [], "exchanges": []}
    for sector in SECTORS:
        for kind, found in files.items():
            path = inventory / sector / f"{kind}.parquet"
            if path.exists():
                found.append(str(path))
                mb = path.stat().st_size / 1e6
                told.append((f"{sector}/{kind} is below {MOST_MB} MB", mb < MOST_MB, f"{mb:.1f}"))
        meta = inventory / sector / "metadata.json"
        if meta.exists():
            told.append((f"{sector}/metadata.json is complete", METADATA_KEYS <= set(json.loads(meta.read_text("utf-8"))), ""))
    if not files["processes"] or not files["exchanges"]:
        return _told(spark, [*told, ("processes and exchanges are staged", False, "")])
    # files are read one by one into contract types: a column that is null in one sector may be typed otherwise there
    p = spark.read.option("mergeSchema", False).parquet(*files["processes"])
    x = spark.read.option("mergeSchema", False).parquet(*files["exchanges"])
    out = [checks.unique(p, "process_id", "process ids are unique"), checks.not_null(p, REQUIRED, "not null: processes."), checks.in_domain(p, "process_type", PROCESS_TYPES, "process types are known")]
    out += [checks.in_domain(x, "flow_type", FLOW_TYPES, "flow types are known"), checks.in_domain(x, "direction", DIRECTIONS, "directions are known")]
    if expected is not None:
        out.append(checks.row_count(p, expected, f"there are {expected} processes"))
    kind = F.col("flow_type")
    out.append(checks.refers(x, F.col("process_id"), p, "process_id", "exchanges belong to processes"))
    out.append(checks.refers(x, F.when(kind.isin("production", "technosphere"), F.col("flow")), p, "process_id", "inputs and products are processes"))
    terms = sorted(str(f) for f in (root / "vocab/elementary-flows").glob("*.parquet"))
    if terms:
        out.append(checks.refers(x, F.when(kind == "biosphere", F.col("flow")), spark.read.parquet(*terms), "notation", "biosphere flows are terms"))
    else:
        told.append(("flow terms are staged", False, ""))
    if products is not None:
        out.append(_coverage(p, products))
    return checks.report(*out, _told(spark, told))
