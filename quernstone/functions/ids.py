"""Deterministic identifiers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import slugify_any

#: Fixed value: namespace of elementary-flow ids.
FLOW_NAMESPACE = "4b09f7bf-2fce-5cab-8f65-37460e420355"
#: Base of published identifiers; a parameter of every builder.
BASE = "https://vocab.example"


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version-5 UUID of ``name``, made of built-ins only (SHA-1 and bit fields)."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def flow_id(name: Column, category: Column, subcategory: Column, namespace: str = FLOW_NAMESPACE) -> Column:
    """Id of an elementary flow; null parts count as empty."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    return uuid5(namespace, F.concat_ws("|", empty(name), empty(category), empty(subcategory)))


def iri(*parts: str | Column, base: str = BASE) -> Column:
    """``base/part/part``; null if a part is."""
    cols = [F.lit(base)]
    for p in parts:
        cols += [F.lit("/"), F.lit(p) if isinstance(p, str) else p]
    return F.concat(*cols)


def slug_iri(label: Column, *parts: str, base: str = BASE) -> Column:
    """An IRI that ends in the label's slug."""
    return iri(*parts, slugify_any(label), base=base)


def code_or_slug_iri(code_iri: Column, label: Column, *parts: str, base: str = BASE) -> Column:
    """The code's IRI, else one made of the label."""
    return F.coalesce(code_iri, slug_iri(label, *parts, base=base))


def method_id(impact: Column, datasource: str) -> Column:
    return F.concat(F.lit(f"{datasource}:"), slugify_any(impact))


def digest(c: Column) -> Column:
    """SHA-256 in hex."""
    return F.sha2(c, 256)
