"""Duplicates within a delivery and against what is already published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.errors import DedupError
from quernstone.functions.text import normalize_label

POLICIES = ("skip", "error", "overwrite")


def content(df: DataFrame, columns: list[str]) -> Column:
    """A 64-bit hash of the columns; maps, which have no order to hash, go in as JSON."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    parts = [F.to_json(F.struct(c)) if c in maps else F.col(c) for c in columns]
    # a null leaves the hash as it was, so the places of nulls are hashed, too
    return F.xxhash64(*parts, *(F.col(c).isNull() for c in columns)) if columns else F.lit(0).cast("bigint")


def first_wins(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The first row of every key by ``order``; null is a key like any other.

    Aggregates whole rows with a min over (order, row), which combines before the shuffle, so a hot
    key never gathers its rows in one task. Repeated orders are settled by the row's own content.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(order, *rest), F.struct(F.col(order), content(df, rest))).alias("row"))
    return best.select(*keys, "row.*").select(*df.columns)


def conflicts(df: DataFrame, key: str = "iri", order: str = "ord") -> DataFrame:
    """(key, n_variants) of identifiers whose rows differ in any other column than ``order``."""
    rows = content(df, [c for c in df.columns if c not in (key, order)])
    found = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(rows).alias("n_variants"))
    return found.where("n_variants > 1")


def intra(df: DataFrame, key: str = "iri", order: str = "ord") -> DataFrame:
    """Equal rows of an identifier collapse to the first; differing ones raise; rows without identifier pass."""
    bad = conflicts(df, key, order).limit(20).collect()
    if bad:
        raise DedupError("rows of one identifier differ: " + ", ".join(sorted(str(r[0]) for r in bad)))
    return first_wins(df.where(F.col(key).isNotNull()), [key], order).unionByName(df.where(F.col(key).isNull()))


def label_collisions(df: DataFrame, key: str = "iri", label: str = "pref_label", order: str = "ord") -> DataFrame:
    """(key, label, first): rows whose identifier is not the first one seen for their normalised label."""
    norm = normalize_label(F.col(label))
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, label, order, norm.alias("norm"))
    firsts = rows.groupBy("norm").agg(F.min_by(key, F.struct(order, key)).alias("first"))
    return rows.join(firsts, "norm").where(F.col(key) != F.col("first")).select(key, label, "first")


def against(df: DataFrame, existing: DataFrame, policy: str = "skip", key: str = "iri") -> DataFrame:
    """``df`` under a policy for identifiers that exist already.

    skip drops them, overwrite keeps them, error raises if there is one; an unknown policy always
    raises. Rows without identifier pass.
    """
    if policy not in POLICIES:
        raise DedupError(f"unknown policy {policy!r}")
    known = existing.select(F.col(key).alias("known_key")).where("known_key is not null").distinct()
    same = df[key] == known["known_key"]
    if policy == "error":
        hit = df.join(known, same, "left_semi").select(key).limit(20).collect()
        if hit:
            raise DedupError("identifiers exist already: " + ", ".join(sorted(str(r[0]) for r in hit)))
    return df.join(known, same, "left_anti") if policy == "skip" else df


def existing_collisions(df: DataFrame, existing: DataFrame, key: str = "iri", label: str = "pref_label") -> DataFrame:
    """(key, label, existing): rows whose normalised label is published under another identifier.

    The published labels are first-wins by identifier, so one row comes out per incoming row.
    """
    e = existing.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(normalize_label(F.col(label)).alias("norm"), F.col(key).alias("existing")).groupBy("norm").agg(F.min("existing").alias("existing"))
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull()).withColumn("norm", normalize_label(F.col(label)))
    return rows.join(e, "norm").where(F.col(key) != F.col("existing")).select(key, label, "existing")


def distinct_ordered(df: DataFrame, column: str, order: str = "ord") -> DataFrame:
    """Distinct non-empty values with the order of their first row."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(column).agg(F.min(order).alias(order))


def collect_ordered(df: DataFrame, keys: list[str], value: Column, order: str = "ord", name: str = "items") -> DataFrame:
    """One row a key with its values in order; for groups that fit a row by nature (members of a document)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), value.alias("value"))))
    return df.groupBy(*keys).agg(F.transform(items, lambda x: x["value"]).alias(name))
