"""Uncertainty of exchange amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uncertainty(amount: Column, kind: Column, sd95: Column) -> tuple[Column, Column, Column]:
    """(uncertainty_type, loc, scale) of an amount whose 95 % spread is ``sd95``.

    kind ``1`` is lognormal (2, ln|amount|, ln sqrt(sd95)), not for amount 0; kind ``2`` is normal
    (3, amount, sd95 / 2). Other kinds, and an absent or non-positive sd95, give nulls.
    """
    given = sd95.isNotNull() & (sd95 > 0)
    log = given & (kind == "1") & (amount != 0)
    normal = given & (kind == "2")
    code = F.when(log, 2).when(normal, 3).cast("bigint")
    loc = F.when(log, F.ln(F.abs(amount))).when(normal, amount)
    scale = F.when(log, F.ln(F.sqrt(sd95))).when(normal, sd95 / 2)
    return code, loc, scale
