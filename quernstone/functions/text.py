"""Text functions as Columns; pandas UDFs only where Spark has no built-in."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quernstone.functions.keys import NULLISH, stripped
from quernstone.functions.spelling import repair


def squash(c: Column) -> Column:
    """White space of any kind collapsed to single spaces, none at the ends; null is ``''``."""
    return F.coalesce(F.btrim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")), F.lit(""))


def nonblank(c: Column) -> Column:
    """True where the text has a visible character; null is false."""
    return F.coalesce(F.length(stripped(c)) > 0, F.lit(False))


def blank_to_null(c: Column) -> Column:
    """Stripped text, null where nothing is left."""
    s = stripped(c)
    return F.when(s != "", s)


def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case letters whose folded form differs: those of one letter, and those of several."""
    one, more = {}, {}
    for i in range(0x80, 0x10000):
        c = chr(i)
        if c.lower() == c != c.casefold():
            (one if len(c.casefold()) == 1 else more)[c] = c.casefold()
    return one, more


_ONE, _MORE = _foldings()


def folded(c: Column) -> Column:
    """Full case folding of the Unicode standard, as str.casefold() has it, from built-ins."""
    low = F.lower(c)
    table = F.create_map(*(F.lit(x) for kv in _MORE.items() for x in kv))
    letters = F.array_join(F.transform(F.split(low, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    return F.translate(F.when(low.rlike("[" + "".join(_MORE) + "]"), letters).otherwise(low), "".join(_ONE), "".join(_ONE.values()))


def normalize_label(c: Column) -> Column:
    """A label for comparison: single spaces, case folded."""
    return folded(squash(c))


def _slug(text: str | None) -> str | None:
    if text is None:
        return None
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii").lower()
    return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")


@F.pandas_udf(StringType())
def slugify_any(s: pd.Series) -> pd.Series:
    """Slug with accents taken off; letters without a decomposition vanish."""
    return s.map(_slug, na_action="ignore")


def compartment_slug(c: Column) -> Column:
    """Slug of ASCII text: lower case, other characters to single hyphens, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def title(c: Column) -> Column:
    """Every run of ASCII letters capitalised, white space taken off the ends. Other alphabets need :func:`title_any`."""
    runs = F.regexp_extract_all(stripped(c), F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1_000_000)))), "")


@F.pandas_udf(StringType())
def title_any(s: pd.Series) -> pd.Series:
    """Python's strip().title()."""
    return s.str.strip().str.title()


def strip_html(c: Column) -> Column:
    """Without tags, white space collapsed."""
    return squash(F.regexp_replace(c, "<[^>]+>", ""))


def before(c: Column, mark: str) -> Column:
    """Text before the first ``mark``, stripped; null where nothing is left."""
    return blank_to_null(F.substring_index(c, mark, 1))


def definition(text: Column, flag: Column | None = None, marker: str = "[obsolete] ", length: int = 500) -> Column:
    """Collapsed text cut to ``length`` characters, after a marker where ``flag`` holds; null if empty."""
    body = F.substring(squash(text), 1, length)
    if flag is not None:
        body = F.when(F.coalesce(flag, F.lit(False)), F.concat(F.lit(marker), body)).otherwise(body)
    return F.when(body != "", body)


def comment(category: Column, subcategory: Column, flag: Column, marker: str, citation: str, label: str = "Category") -> Column:
    """``Category: a / b. marker. Source: citation``; the marker only where ``flag`` holds."""
    head = F.concat(F.lit(f"{label}: "), F.coalesce(category, F.lit("")), F.lit(" / "), F.coalesce(subcategory, F.lit("")))
    return F.concat_ws(". ", head, F.when(flag, F.lit(marker)), F.lit(f"Source: {citation}"))


def path(*parts: Column) -> Column:
    """``a / b / c`` of the parts that are not empty, each stripped; null if there is none. Blank parts stay as empty ones."""
    joined = F.concat_ws(" / ", *(F.when(p != "", stripped(p)) for p in parts))
    return F.when(joined != "", joined)


def denulled(c: Column) -> Column:
    """Stripped text; texts that stand for a missing value, and null, are ``''``."""
    s = stripped(c)
    return F.when(c.isNull() | F.lower(s).isin(NULLISH), F.lit("")).otherwise(s)


@F.pandas_udf(StringType())
def repaired(s: pd.Series) -> pd.Series:
    """Up to three readings of cp1252 or latin-1 text as UTF-8. Exact restoration over all encodings is another operator's work."""
    return s.map(lambda t: repair(t, ("cp1252", "latin-1")), na_action="ignore")


def iso(ts: Column) -> Column:
    """ISO-8601 text of a timestamp, with microseconds where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
