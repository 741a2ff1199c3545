"""Closed-world validation of rows against YAML class schemas.

A class becomes one array Column of problems per row, so validation is a filter over the frame and
not a loop; only offending rows reach the driver. Supported: attributes and slots, required,
identifier, multivalued, ranges of enums and URIs, imports of neighbouring files, closed slots.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.errors import ValidationError

_SHOWN = 50


def load(path: Path, seen: set[Path] | None = None) -> dict:
    """Classes, slots and enums of a schema file and of the local files it imports."""
    seen = seen if seen is not None else set()
    if path in seen:
        return {"classes": {}, "slots": {}, "enums": {}}
    seen.add(path)
    if not path.exists():
        raise ValidationError(f"no schema file {path}")
    doc = yaml.safe_load(path.read_text("utf-8")) or {}
    out: dict = {"classes": {}, "slots": {}, "enums": {}}
    for name in doc.get("imports") or []:
        if isinstance(name, str) and ":" not in name:
            for k, v in load(path.parent / f"{name}.yaml", seen).items():
                out[k] |= v
    for k in out:
        out[k] |= doc.get(k) or {}
    return out


def slots(schema: dict, cls: str) -> dict[str, dict]:
    """name -> definition of the class' slots, inherited ones first."""
    c = schema["classes"].get(cls)
    if c is None:
        raise ValidationError(f"the schema has no class {cls!r}")
    out = slots(schema, c["is_a"]) if c.get("is_a") else {}
    for s in c.get("slots") or []:
        out[s] = dict(schema["slots"].get(s) or {})
    for s, d in (c.get("attributes") or {}).items():
        out[s] = dict(d or {})
    for s, d in (c.get("slot_usage") or {}).items():
        out[s] = out.get(s, {}) | dict(d or {})
    return out


def struct(schema: dict, cls: str) -> T.StructType:
    """Columns of a class in slot order: multivalued slots are arrays of strings, the others strings."""
    return T.StructType([T.StructField(n, T.ArrayType(T.StringType()) if d.get("multivalued") else T.StringType()) for n, d in slots(schema, cls).items()])


def _outside(allowed: list[str]) -> Callable:
    return lambda x: ~x.isin(allowed)


def _known(bad: Callable) -> Callable:
    return lambda x: F.coalesce(bad(x), F.lit(False))


def problems(df: DataFrame, schema: dict, cls: str, order: str = "ord") -> DataFrame:
    """(row, problem) of every violation; row is ``order`` or null without that column."""
    rules, found = slots(schema, cls), []
    for c in df.columns:
        if c != order and c not in rules:
            found.append(F.when(F.col(f"`{c}`").isNotNull(), F.lit(f"slot {c!r} is not allowed")))
    types = dict(df.dtypes)
    for n, d in rules.items():
        need = bool(d.get("required") or d.get("identifier"))
        if n not in df.columns:
            found += [F.lit(f"slot {n!r} is required")] if need else []
            continue
        c, many = F.col(f"`{n}`"), types[n].startswith("array")
        if bool(d.get("multivalued")) != many:
            found.append(F.when(c.isNotNull(), F.lit(f"slot {n!r} should be {'a list' if not many else 'one value'}")))
            continue
        if need:
            found.append(F.when(c.isNull(), F.lit(f"slot {n!r} is required")))
        allowed = list((schema["enums"].get(d.get("range")) or {}).get("permissible_values") or [])
        bad: Callable | None = None
        if allowed:
            bad = _outside(allowed)
        elif d.get("range") in ("uriorcurie", "uri"):
            bad = lambda x: ~x.rlike(r"\A[A-Za-z][\w+.-]*:\S*\z")
        if bad is not None:
            hit = F.exists(c, _known(bad)) if many else bad(c)
            found.append(F.when(hit, F.concat(F.lit(f"slot {n!r} has the value "), F.to_json(F.struct(c)) if many else c)))
    ids = [n for n, d in rules.items() if d.get("identifier") and n in df.columns]
    row = F.col(order) if order in df.columns else F.lit(None).cast("bigint")
    each = F.filter(F.array(*found) if found else F.array().cast("array<string>"), lambda x: x.isNotNull())
    out = df.select(row.alias("row"), F.explode(each).alias("problem"))
    for n in ids:  # an identifier names one row
        twice = df.where(F.col(n).isNotNull()).groupBy(n).agg(F.count("*").alias("k"), F.min(row).alias("row")).where("k > 1")
        out = out.unionByName(twice.select("row", F.concat(F.lit(f"slot {n!r} repeats "), F.col(n)).alias("problem")))
    return out


def _raise(bad: DataFrame, what: str) -> None:
    rows = bad.orderBy("row", "problem").limit(_SHOWN).collect()
    if rows:
        raise ValidationError(f"{what}:\n" + "\n".join(f"row {r['row']}: {r['problem']}" for r in rows))


def validate_none(df: DataFrame, envelope: dict | None, path: Path | None, cls: str | None) -> None:
    """For targets without a schema."""


def validate_rows(df: DataFrame, envelope: dict | None, path: Path | None, cls: str | None) -> None:
    if path is None or cls is None:
        raise ValidationError("a schema and a class are needed")
    _raise(problems(df, load(path), cls), "rows break the schema")


def validate_collection(df: DataFrame, envelope: dict | None, path: Path | None, cls: str | None) -> None:
    """The collection's own slots, then its items against the class of its list."""
    if path is None or cls is None:
        raise ValidationError("a schema and a class are needed")
    schema = load(path)
    rules = slots(schema, cls)
    have = {k for k, v in (envelope or {}).items() if v is not None}
    items = [n for n, d in rules.items() if d.get("multivalued") and d.get("range") in schema["classes"]]
    wrong = [f"slot {n!r} is required" for n, d in rules.items() if d.get("required") and n not in have and n not in items] + [f"slot {n!r} is not allowed" for n in sorted(have - set(rules))]
    if wrong:
        raise ValidationError("the collection breaks the schema:\n" + "\n".join(wrong))
    for n in items[:1]:
        _raise(problems(df, schema, rules[n]["range"]), "items break the schema")


def package_problems(entries: DataFrame) -> DataFrame:
    """(row, problem): mapping entries need a source with at least one property."""
    row = F.col("ord") if "ord" in entries.columns else F.lit(None).cast("bigint")
    empty = F.col("source").isNull() | (F.to_json("source") == "{}")
    return entries.where(empty).select(row.alias("row"), F.lit("source has no property").alias("problem"))


def validate_package(df: DataFrame, envelope: dict | None, path: Path | None, cls: str | None) -> None:
    missing = [k for k in ("name", "version") if not (envelope or {}).get(k)]
    if missing:
        raise ValidationError("the package lacks " + ", ".join(missing))
    _raise(package_problems(df), "entries break the package profile")


Validator = Callable[[DataFrame, dict | None, Path | None, str | None], None]
_VALIDATORS: dict[str, Validator] = {"none": validate_none, "schema": validate_rows, "collection": validate_collection, "package": validate_package}


def register(name: str, validator: Validator) -> None:
    _VALIDATORS[name] = validator


def validate(df: DataFrame, strategy: str, envelope: dict | None = None, path: Path | None = None, cls: str | None = None) -> None:
    if strategy not in _VALIDATORS:
        raise ValidationError(f"no validator {strategy!r}")
    _VALIDATORS[strategy](df, envelope, path, cls)
