"""Keys as Columns: two keys are equal apart from letter case and surrounding white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every Unicode white-space character that strip() removes.
WHITE = "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts that stand for a missing value.
NULLISH = ["", "nan", "none", "<na>"]


def stripped(c: Column) -> Column:
    """Without surrounding white space of any kind."""
    return F.btrim(c, F.lit(WHITE))


def key(c: Column) -> Column:
    """The comparable form of a key; null where the text is no key."""
    k = F.lower(stripped(c))
    return F.when(~k.isin(NULLISH), k)


def month(ts: Column) -> Column:
    """Months since year 0, as INT."""
    return (F.year(ts) * 12 + F.month(ts)).cast("int")
