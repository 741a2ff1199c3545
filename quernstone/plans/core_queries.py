"""The queries of the general training-data problems (p1 to p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.keys import key
from quernstone.operators.hierarchy import descendants, hierarchy
from quernstone.operators.packed import unpack
from quernstone.operators import units as un
from quernstone.operators.references import orphans, report
from quernstone.session import cut

SEP = "\x1f"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def latest_nodes(df: DataFrame, tab: str, node: str, parent: str) -> DataFrame:
    """The latest row of each node: (node, parent, written); ties go to the larger rec_id, null times come first."""
    k = key(F.col(node))
    rows = df.select(k.alias("k"), F.struct(F.col("loaded_at"), F.col("rec_id"), F.col(node).alias("written"), key(F.col(parent)).alias("up")).alias("r")).where("k is not null")
    best = rows.groupBy("k").agg(F.max("r").alias("r"))
    tag = lambda c: F.concat(F.lit(tab + SEP), c)
    return best.select(tag(F.col("k")).alias("node"), tag(F.col("r.up")).alias("parent"), F.col("r.written").alias("written"))


def p1_nodes(spark: SparkSession, d: str) -> DataFrame:
    terms = latest_nodes(table(spark, d, "terms"), "terms", "termCode", "parentCode")
    return terms.unionByName(latest_nodes(table(spark, d, "concepts"), "concepts", "iri", "broader"))


def _written(tree: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """``column`` of ``tree`` replaced by the node's text as written."""
    names = nodes.select(F.col("node").alias("w_node"), F.col("written").alias("w_text"))
    return tree.join(names, F.col(column) == F.col("w_node"), "left").withColumn(column, F.coalesce("w_text", F.col(column))).drop("w_node", "w_text")


def _tab(c: str):
    return F.split_part(F.col(c), F.lit(SEP), F.lit(1))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = p1_nodes(spark, d)
    tree = hierarchy(nodes).select(_tab("node").alias("tab"), "node", "root", "depth")
    return _written(_written(tree, nodes, "node"), nodes, "root").select("tab", "node", "root", "depth")


def p1_paths(spark: SparkSession, d: str) -> DataFrame:
    tree = hierarchy(p1_nodes(spark, d), paths=True)
    path = F.array_join(F.transform("chain", lambda x: F.split_part(x, F.lit(SEP), F.lit(2))), " > ")
    return tree.select(_tab("node").alias("tab"), F.split_part("node", F.lit(SEP), F.lit(2)).alias("node"), "depth", path.alias("path"))


def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    pairs = descendants(hierarchy(p1_nodes(spark, d), paths=True))
    last = lambda c: F.split_part(c, F.lit(SEP), F.lit(2))
    return pairs.select(_tab("ancestor").alias("tab"), last("ancestor").alias("ancestor"), last("descendant").alias("descendant"), "distance")


def p2_misses(spark: SparkSession, d: str) -> DataFrame:
    ex = table(spark, d, "exchanges").select("rec_id", "process_id", "flow", "flow_type", "loaded_at")
    kind = key(F.col("flow_type"))
    to = F.when(kind.isin("production", "technosphere"), F.lit("processes")).when(kind == "biosphere", F.lit("flows"))
    both = F.array(
        F.struct(F.lit("process_id").alias("field"), F.lit("processes").alias("to"), F.col("process_id").alias("ref")),
        F.struct(F.lit("flow").alias("field"), to.alias("to"), F.col("flow").alias("ref")),
    )
    refs = ex.select(F.lit("exchanges").alias("tab"), "rec_id", "loaded_at", F.inline(both)).where("to is not null")
    related = table(spark, d, "concepts").select(F.lit("concepts").alias("tab"), "rec_id", "loaded_at", F.lit("related").alias("field"), F.lit("concepts").alias("to"), F.explode(F.array_distinct("related")).alias("ref"))
    old = lambda name, k: table(spark, d, name).select(F.lit(name).alias("to"), F.col(k).alias("key"), "rec_id", "loaded_at", "deleted_at")
    parents = old("processes", "process_id").unionByName(old("flows", "notation")).unionByName(old("concepts", "iri"))
    return orphans(refs.unionByName(related), parents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_misses(spark, d).select("tab", "rec_id", "field", "ref_key", "kind")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return report(p2_misses(spark, d))


def p3_values(spark: SparkSession, d: str, least: int = 1) -> DataFrame:
    terms = table(spark, d, "terms")
    facet = lambda f: terms.select("rec_id", F.lit(f).alias("field"), F.try_element_at("attrs", F.lit(f)).alias("packed"))
    packed = unpack(facet("allFacets").unionByName(facet("implicitFacets")), "facets", least)
    notes = unpack(terms.select("rec_id", F.lit("termScopeNote").alias("field"), F.array("termScopeNote").alias("packed")), "note", least)
    return packed.unionByName(notes)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_values(spark, d, least=2).select("rec_id", "field", "pos", "value")


def p3_flags(spark: SparkSession, d: str) -> DataFrame:
    """How many values each field has and how many needed a second reading."""
    return p3_values(spark, d).groupBy("field").agg(F.count("*").alias("n_values"), F.count("flag").alias("n_flagged"))


def p4_parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(amounts, pairs, vocabulary, unit table)."""
    units = table(spark, d, "units")
    fixed = un.fixed(units)
    ex = table(spark, d, "exchanges").select("rec_id", "flow", "flow_name", "amount", "unit").where("amount is not null")
    amounts = ex.select(
        F.lit("exchanges").alias("tab"), "rec_id", key(F.col("flow")).alias("entity"), "amount", "unit",
        F.coalesce(un.said(F.col("unit")), un.in_name(F.col("flow_name"))).alias("spelling"),
    )
    pairs = table(spark, d, "crosswalk").select(
        F.lit("crosswalk").alias("tab"), "rec_id", un.said(F.col("source_unit")).alias("a"), un.said(F.col("target_unit")).alias("b"), F.col("unit_conversion").alias("factor")
    )
    entity = un.links_by_entity(amounts, list(fixed["unit_code"]), bool((fixed["offset"] != 0).any()))
    links = cut(entity.unionByName(un.links_by_factor(pairs)))
    spellings = amounts.select("spelling").distinct().unionByName(pairs.select(F.explode(F.array("a", "b")).alias("spelling")).distinct())
    return amounts, pairs, un.vocabulary(spellings, links, units), units


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    amounts, pairs, vocab, units = p4_parts(spark, d)
    rows = un.common_amounts(amounts, vocab, units).unionByName(un.wrong_factors(pairs, vocab, units))
    return un.scientific(rows, "value", "tab string, rec_id bigint, unit string, value string")


def p4_units(spark: SparkSession, d: str) -> DataFrame:
    """What every spelling of a unit was taken for."""
    return p4_parts(spark, d)[2].select("spelling", "multiplier", "unit_code")


def p4_grounds(spark: SparkSession, d: str) -> DataFrame:
    """How many spellings were taken for a unit on what ground."""
    return p4_parts(spark, d)[2].groupBy("how").agg(F.count("*").alias("n_spellings"))


QUERIES = {
    "p1_found": p1_found,
    "p1_paths": p1_paths,
    "p1_descendants": p1_descendants,
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p3_found": p3_found,
    "p3_flags": p3_flags,
    "p4_found": p4_found,
    "p4_units": p4_units,
    "p4_grounds": p4_grounds,
}
