"""Functions of string arrays, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import folded


def _texts(*items: Column) -> Column:
    """An empty array of strings where the array is null."""
    return F.coalesce(*items, F.array().cast("array<string>"))


def dedupe(arr: Column) -> Column:
    """First spelling of every value, in order; case does not count, empty and null values vanish."""
    kept = F.filter(_texts(arr), lambda x: x.isNotNull() & (x != ""))
    return F.aggregate(kept, F.array().cast("array<string>"), lambda acc, v: F.when(F.exists(acc, lambda a: folded(a) == folded(v)), acc).otherwise(F.concat(acc, F.array(v))))


def without(arr: Column, label: Column) -> Column:
    """Values that differ from the label by more than case."""
    return F.filter(arr, lambda x: ~folded(x).eqNullSafe(folded(label)))


def empty_to_null(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def alt_labels(label: Column, *sources: Column) -> Column:
    """All values of the sources (strings or arrays) in order, deduplicated, without the label."""
    return empty_to_null(without(dedupe(F.concat(*(_texts(s) for s in sources))), label))


def facet_codes(spec: Column) -> Column:
    """Codes of ``own#F01.X$F02.Y``: the part after the first dot of each segment; segments without a dot vanish."""
    body = F.regexp_replace(spec, "^[^#]*#", "")
    parts = F.filter(F.split(body, r"\$"), lambda x: F.contains(x, F.lit(".")))
    codes = F.transform(parts, lambda x: F.btrim(F.regexp_replace(x, r"^[^.]*\.", "")))
    return F.filter(codes, lambda x: x != "")


def prefixed(arr: Column, prefix: str) -> Column:
    """``prefix:value`` of every value."""
    return F.transform(_texts(arr), lambda x: F.concat(F.lit(f"{prefix}:"), x))


def exact_matches(associations: Column) -> Column:
    """Distinct source and target ids of the associations whose type ends in exactMatch, in order."""
    exact = F.filter(F.coalesce(associations, F.array()), lambda a: F.coalesce(F.endswith(a["type"], F.lit("exactMatch")), F.lit(False)))
    ids = F.flatten(F.transform(exact, lambda a: F.array(a["source"], a["target"])))
    return F.array_distinct(F.filter(ids, lambda x: x.isNotNull() & (x != "")))


def first_element(arr: Column) -> Column:
    """The first element, null for empty and null arrays."""
    return F.try_element_at(arr, F.lit(1))


def ordered(items: Column) -> Column:
    """Second field of (position, value) structs, by position."""
    return F.transform(F.array_sort(items), lambda x: x.getField("value"))
