"""Rows to documents: mapping entries, exchanges, nested payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import ids, routing, text
from quernstone.functions.keys import stripped
from quernstone.functions.uncertainty import uncertainty


def crosswalk_entries(df: DataFrame, target_db: str = "ef", notes: dict[str, str] | None = None, namespace: str = ids.FLOW_NAMESPACE, keep: list[str] | None = None) -> DataFrame:
    """Mapping entries (source, target, conversion_factor, comment) of linked rows.

    Rows need a name, a target code and the wanted target database. Texts that stand for a missing
    value are absent. An empty list of categories gives no context, one of blanks only an empty one.
    """
    t = {c: text.denulled(F.col(c)) for c in ("source_name", "source_category", "source_subcategory", "source_unit", "target_code", "target_name", "target_unit")}
    some = lambda c: F.when(t[c] != "", t[c])
    context = F.filter(F.array(some("source_category"), some("source_subcategory")), lambda x: x.isNotNull())
    cleaned = F.filter(F.transform("target_categories", text.denulled), lambda x: x != "")
    source = F.struct(t["source_name"].alias("name"), ids.flow_id(t["source_name"], t["source_category"], t["source_subcategory"], namespace).alias("code"), some("source_unit").alias("unit"), F.when(F.size(context) > 0, context).alias("context"))
    target = F.struct(some("target_name").alias("name"), t["target_code"].alias("code"), some("target_unit").alias("unit"), F.when(F.size("target_categories") > 0, cleaned).alias("context"))
    note = routing.lookup(notes, text.denulled(F.col("tier"))) if notes else F.lit(None).cast("string")
    rows = df.where((t["source_name"] != "") & (t["target_code"] != "") & (F.col("target_db") == target_db))
    return rows.select(*(keep or []), source.alias("source"), target.alias("target"), routing.real_factor(F.col("unit_conversion")).alias("conversion_factor"), note.alias("comment"))


def curated_entries(df: DataFrame, allowed: list[str], barred_part: str, dropped: list[str], keep: list[str] | None = None) -> DataFrame:
    """Mapping entries of a curated crosswalk that may be passed on; names are required, ``nan`` texts stay as delivered."""
    rows = df.where(routing.shippable(F.col("target_db"), F.col("provenance"), allowed, barred_part, dropped) & text.nonblank(F.col("source_name")) & text.nonblank(F.col("target_name")))
    some = lambda c: text.blank_to_null(F.col(c))
    context = F.filter("source_context", lambda x: x.isNotNull() & (x != ""))
    full = lambda c: F.when(F.col(c) != "", F.col(c))
    source = F.struct(stripped(F.col("source_name")).alias("name"), some("source_unit").alias("unit"), F.when(F.size(context) > 0, context).alias("context"), full("source_cas").alias("cas_number"))
    target = F.struct(stripped(F.col("target_name")).alias("name"), some("target_unit").alias("unit"), full("target_code").alias("code"))
    comment = F.format_string("%s (priority tier %s)", F.coalesce("provenance", F.lit("")), F.coalesce(F.col("priority_tier").cast("string"), F.lit("None")))
    return rows.select(*(keep or []), source.alias("source"), target.alias("target"), routing.real_factor(F.col("unit_conversion")).alias("conversion_factor"), comment.alias("comment"))


def exchange_rows(datasets: DataFrame, index: DataFrame, namespace: str = ids.FLOW_NAMESPACE) -> DataFrame:
    """Exchange table of datasets (uuid, exchanges ARRAY<STRUCT>, ord): one row an exchange, in order.

    index: (number, uuid) of every dataset; an input whose number it lacks keeps the number.
    """
    x = datasets.select("ord", F.col("uuid").alias("process_id"), F.posexplode("exchanges").alias("at", "x")).select("ord", "at", "process_id", "x.*")
    kind = routing.flow_type(F.col("group"), F.col("group_code"))
    i = index.select(F.col("number").alias("i_number"), F.col("uuid").alias("i_uuid"))
    x = x.withColumn("flow_type", kind).join(i, (F.col("flow_type") == "technosphere") & (F.col("number") == F.col("i_number")), "left")
    flow = F.when(F.col("flow_type") == "production", F.col("process_id")).when(F.col("flow_type") == "biosphere", ids.flow_id(F.col("name"), F.col("category"), F.col("subcategory"), namespace)).otherwise(F.coalesce("i_uuid", "number"))
    code, loc, scale = uncertainty(F.col("amount"), F.col("uncertainty_type"), F.col("sd95"))
    none = F.lit(None).cast("double")
    return x.select("ord", "at", "process_id", flow.alias("flow"), F.col("name").alias("flow_name"), "flow_type", F.col("group").alias("direction"), "amount", "unit", "location", code.alias("uncertainty_type"), loc.alias("loc"), scale.alias("scale"), none.alias("minimum"), none.alias("maximum"))
