"""Look-ups of one table's references in another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import arrays, ids, routing


def last_wins(df: DataFrame, key: str, value: Column, order: str) -> DataFrame:
    """(key, value): the value of each key's last row by ``order``."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias("value"))


def resolve(df: DataFrame, ref: str, index: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the index' value for ``ref``, the reference itself where it has none.

    index: (key, value) with unique keys. AQE broadcasts it where it is small and splits hot keys
    of ``df`` where it is not.
    """
    i = index.select(F.col(index.columns[0]).alias("i_key"), F.col(index.columns[1]).alias("i_value"))
    return df.join(i, F.col(ref) == F.col("i_key"), "left").withColumn(out, F.coalesce("i_value", F.col(ref))).drop("i_key", "i_value")


def code_index(terms: DataFrame, order: str = "ord") -> DataFrame:
    """(code, category) of all terms, last wins."""
    kind = routing.term_category(F.try_element_at("attrs", F.lit("termType")))
    return last_wins(terms.where("termCode != ''"), "termCode", kind, order).select(F.col("termCode").alias("code"), F.col("value").alias("category"))


def code_iri(category: Column, code: Column, prefix: str, base: str = ids.BASE) -> Column:
    return ids.iri(category, prefix, code, base=base)


def broader(terms: DataFrame, index: DataFrame, prefix: str, base: str = ids.BASE) -> DataFrame:
    """``terms`` with ``broader``: the parent's identifier in the parent's category; null for unknown parents."""
    i = index.select(F.col("code").alias("p_code"), F.col("category").alias("p_category"))
    return terms.join(i, F.col("parentCode") == F.col("p_code"), "left").withColumn("broader", code_iri(F.col("p_category"), F.col("p_code"), prefix, base)).drop("p_code", "p_category")


def related(terms: DataFrame, index: DataFrame, prefix: str, base: str = ids.BASE, order: str = "ord") -> DataFrame:
    """(order, related): identifiers behind the facets of each term, explicit before implicit, first mention only; self and unknown codes vanish."""
    specs = lambda k: F.coalesce(F.try_element_at("attrs", F.lit(k)), F.array().cast("array<string>"))
    codes = F.flatten(F.transform(F.concat(specs("allFacets"), specs("implicitFacets")), arrays.facet_codes))
    links = terms.select(order, "termCode", F.posexplode(codes).alias("at", "code")).where(~F.col("code").eqNullSafe(F.col("termCode")))
    found = links.join(index, "code").select(order, "at", code_iri(F.col("category"), F.col("code"), prefix, base).alias("iri"))
    first = found.groupBy(order, "iri").agg(F.min("at").alias("at"))
    return first.groupBy(order).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "iri"))), lambda x: x["iri"]).alias("related"))
