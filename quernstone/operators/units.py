"""Amounts in many units brought to common units.

The spellings of units are the sources and the flows are the entities they share. For each flow
every spelling is compared with the flow's anchor spelling (robust median of the log ratio, and for
units with an offset a robust line through the flows' medians); a conversion factor delivered with
two spellings is a second kind of link. Links are gathered into a graph of spellings, known unit
codes start it, and each spelling reached is snapped to a known conversion of its quantity - what its
words suggest is a prior that the links can overrule - and then passes its own conversion on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.errors import TransformError
from quernstone.functions import spelling as sp
from quernstone.functions.keys import stripped
from quernstone.session import cut

#: Cost, in nats, of reading a spelling against its words; about six standard errors.
AGAINST_WORDS = 18.0
#: A spelling without known words needs its best conversion to lead the second by this, within NEAR standard errors.
LEAD, NEAR = 8.0, 3.5
UNIT_ROWS = 10_000  #: the unit table is held on every task; more rows are refused
BROADCAST_ROWS = 50_000  #: a vocabulary of more spellings is joined by shuffle

#: Unit texts that say nothing.
SAYS_NOTHING = ["", "nan", "none", "<na>", "n/a", "na", "n.a.", "null", "unknown"]
_IN_NAME = r"(?:\[([^\[\]]{1,40})\]|\(((?:[^()]|\([^()]*\)){1,40})\)|(?:,\s+in|,\s+per|;\s*unit:|\samount in)\s+((?:[^,;\[\]()]|\([^()]*\)){1,40}))\s*$"


def said(unit: Column) -> Column:
    """The unit text, or null where it says nothing."""
    s = stripped(unit)
    return F.when(~F.lower(s).isin(SAYS_NOTHING) & s.rlike(r"\p{L}"), unit)


def in_name(name: Column) -> Column:
    """A unit written at the end of a name: [kg], (kg), ', in kg', ', per kg', '; unit: kg', 'amount in kg'."""
    found = F.concat(*(F.regexp_extract(name, _IN_NAME, i) for i in (1, 2, 3)))
    return F.when(found != "", found)


def with_offset(units: DataFrame) -> DataFrame:
    """An amount times ``factor`` plus ``offset`` is the amount in the common unit."""
    return units.withColumn("offset", F.coalesce("offset", F.lit(0.0)) if "offset" in units.columns else F.lit(0.0))


def fixed(units: DataFrame) -> pd.DataFrame:
    """The unit table; refused beyond ``UNIT_ROWS`` rows. An ``offset`` it does not have is 0."""
    rows = with_offset(units).select("unit_code", "unit_name", "quantity", "common_unit", "factor", "offset").where("unit_code is not null and factor > 0").limit(UNIT_ROWS + 1).toPandas()
    if len(rows) > UNIT_ROWS:
        raise TransformError("the unit table is too large")
    return rows.drop_duplicates("unit_code")


_LINK = "a string, b string, d double, n bigint, spread double, slope double, shift double, low double, high double"


def links_by_entity(amounts: DataFrame, codes: list[str], offsets: bool = False) -> DataFrame:
    """(a, b, d, n, spread, slope, shift, low, high): spelling ``a`` against ``b`` over the flows they share.

    amounts: (entity, spelling, amount). Per entity there is one anchor, the known code with most
    rows, else the spelling with most rows; each other spelling is linked to it alone, so links
    grow with spellings, not with their square. d is the log10 scale of ``a``. With ``offsets`` a
    line is laid through the quartiles of the flows' median amounts as well: an amount x in ``a`` is
    slope * x + shift in ``b``, low and high being the quartiles of x; else these are null.
    """
    good = F.col("amount").isNotNull() & ~F.isnan("amount") & F.col("entity").isNotNull() & F.col("spelling").isNotNull()
    positive = F.when(F.col("amount") > 0, F.log10("amount"))
    raw = F.percentile_approx("amount", 0.5, 200) if offsets else F.lit(None).cast("double")
    some = amounts.where(good if offsets else good & (F.col("amount") > 0))
    seen = cut(some.groupBy("entity", "spelling").agg(F.count("*").alias("rows"), F.percentile_approx(positive, 0.5, 200).alias("med"), raw.alias("raw")))
    anchor = seen.groupBy("entity").agg(F.max(F.struct(F.col("spelling").isin(codes).alias("known"), "rows", F.col("spelling").alias("b"), F.col("med").alias("b_med"), F.col("raw").alias("b_raw"))).alias("x")).select("entity", "x.b", "x.b_med", "x.b_raw")
    d = F.round(F.col("b_med") - F.col("med"), 2)
    per = seen.join(anchor, "entity").where(F.col("spelling") != F.col("b")).select(F.col("spelling").alias("a"), "b", d.alias("d"), "raw", "b_raw")
    if not offsets:
        return _gather(per.where("d is not null").groupBy("a", "b", "d").agg(F.count("*").alias("n")))
    per = cut(per)
    quart = lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75], 1000)
    lines = per.groupBy("a", "b").agg(quart("raw").alias("x"), quart("b_raw").alias("y"), F.count("*").alias("flows"))
    slope = (F.col("y")[2] - F.col("y")[0]) / F.when(F.col("x")[2] > F.col("x")[0], F.col("x")[2] - F.col("x")[0])
    lines = lines.where("flows >= 4").select("a", "b", "flows", slope.alias("slope"), (F.col("y")[1] - slope * F.col("x")[1]).alias("shift"), F.col("x")[0].alias("low"), F.col("x")[2].alias("high"))
    ratios = _gather(per.where("d is not null").groupBy("a", "b", "d").agg(F.count("*").alias("n"))).drop("slope", "shift", "low", "high")
    return lines.join(ratios, ["a", "b"], "full").select("a", "b", "d", F.coalesce("n", "flows").alias("n"), F.coalesce("spread", F.lit(0.0)).alias("spread"), "slope", "shift", "low", "high")


def links_by_factor(pairs: DataFrame) -> DataFrame:
    """The same columns from (a, b, factor) rows, factor turning amounts in ``a`` into amounts in ``b``."""
    d = F.round(F.log10("factor"), 2)
    return _gather(pairs.where("factor > 0 and a is not null and b is not null and a != b").groupBy("a", "b", d.alias("d")).agg(F.count("*").alias("n")))


def _gather(per: DataFrame) -> DataFrame:
    """Weighted median and quartile spread of d; d has two decimals, so the value maps stay small."""
    q = F.expr("percentile(d, array(0.25, 0.5, 0.75), n)")
    none = [F.lit(None).cast("double").alias(c) for c in ("slope", "shift", "low", "high")]
    return per.groupBy("a", "b").agg(q.alias("q"), F.sum("n").alias("n")).select("a", "b", F.col("q")[1].alias("d"), "n", ((F.col("q")[2] - F.col("q")[0]) / 1.349).alias("spread"), *none)


def _turned(links: DataFrame) -> DataFrame:
    """The links seen from ``b``."""
    x = lambda c: F.when(F.col("slope") != 0, c)
    ends = [F.col("slope") * F.col(c) + F.col("shift") for c in ("low", "high")]
    return links.select(F.col("b").alias("a"), F.col("a").alias("b"), (-F.col("d")).alias("d"), "n", "spread", x(1 / F.col("slope")).alias("slope"), x(-F.col("shift") / F.col("slope")).alias("shift"), F.least(*ends).alias("low"), F.greatest(*ends).alias("high"))


_VOCAB = "spelling string, multiplier double, unit_code string, how string"


def vocabulary(spellings: DataFrame, links: DataFrame, units: DataFrame, prior: Callable[[str, dict, set], list[str]] = sp.suggested) -> DataFrame:
    """(spelling, multiplier, unit_code, how): what each spelling stands for.

    Known codes are the roots of the graph; in every round the spellings linked to a resolved one
    are snapped, until none is resolved any more. Spellings that differ in their multiplier alone share
    what their links say. A spelling not told by its links so far is tried
    again with those of the next round. how: ``code``, ``words`` (no link reaches it), ``both``, ``scale`` (words unknown
    or overruled). Spellings that neither links nor words explain have a null unit_code.

    prior: unit codes that the words of a spelling suggest, see :func:`spelling.suggested`.
    """
    table = fixed(units)
    codes, words = set(table["unit_code"]), sp.lexicon(zip(table["unit_code"], table["unit_name"].fillna(""), strict=True))
    quantity, logf = dict(zip(table["unit_code"], table["quantity"], strict=True)), {c: math.log10(f) for c, f in zip(table["unit_code"], table["factor"], strict=True)}
    factor, offset = dict(zip(table["unit_code"], table["factor"], strict=True)), dict(zip(table["unit_code"], table["offset"], strict=True))
    shifted = {quantity[c] for c in codes if offset[c]}  # quantities whose conversions are lines

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [sp.split_multiplier(s) for s in b["spelling"]]
            yield pd.DataFrame({"spelling": b["spelling"], "multiplier": [m for m, _ in got], "base": [x for _, x in got], "words": [prior(x, words, codes) for _, x in got], "exact": [s in codes for s in b["spelling"]]})

    vocab = cut(spellings.select("spelling").where("spelling is not null").distinct().mapInPandas(read, "spelling string, multiplier double, base string, words array<string>, exact boolean"))

    def snap(suggested: list[str], found: list) -> tuple[str | None, str | None]:
        """(unit code, ground) of one base spelling with the links of all its spellings to resolved ones."""
        weight: dict[str, int] = {}
        for r in found:
            weight[r["quantity"]] = weight.get(r["quantity"], 0) + r["n"]
        kind = max(sorted(weight), key=weight.__getitem__)
        cost = {c: 0.0 for c in codes if quantity[c] == kind}
        near = dict.fromkeys(cost, math.inf)
        for r in found:
            if r["quantity"] != kind:
                continue
            if kind in shifted:
                if r["slope"] is None or not r["high"] > r["low"]:
                    continue
                # the line to the common unit against the candidate's, at the quartiles
                wide = abs(r["slope"]) * (r["high"] - r["low"]) * max(0.02, 1 / math.sqrt(r["n"]))
                for c in cost:
                    gaps = [r["slope"] * x + r["shift"] - (factor[c] * x + offset[c]) for x in (r["low"], r["high"])]
                    z = max(abs(g) for g in gaps) / wide
                    cost[c] += min(z * z / 2, 200.0)
                    near[c] = min(near[c], z)
                continue
            if r["scale"] is None:
                continue
            sd = r["spread"] if r["n"] >= 8 else max(r["spread"], 1.3)
            se = max(0.02, 1.25 * sd / math.sqrt(r["n"]))
            for c in cost:
                z = abs(r["scale"] - logf[c]) / se
                cost[c] += min(z * z / 2, 200.0)
                near[c] = min(near[c], z)
        for c in cost:
            cost[c] += AGAINST_WORDS if suggested and c not in suggested else 0.0
        order = sorted(cost, key=lambda c: (cost[c], c))
        best = order[0]
        lead = cost[order[1]] - cost[best] if len(order) > 1 else math.inf
        if suggested and not any(c in cost for c in suggested):
            return suggested[0], "words"  # its flows are of another quantity
        if best in suggested:
            return best, "both"
        if near[best] <= NEAR and lead >= LEAD:
            return best, "scale"
        return (suggested[0], "words") if suggested else (None, None)

    def snapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [snap(list(w), list(x)) for w, x in zip(b["words"], b["found"], strict=True)]
            yield pd.DataFrame({"base": b["base"], "unit_code": [c for c, _ in got], "how": [h for _, h in got]})

    info = F.broadcast(units.sparkSession.createDataFrame([(c, quantity[c], logf[c], float(factor[c]), float(offset[c])) for c in sorted(codes)], "unit_code string, quantity string, logf double, unit_factor double, unit_offset double"))  # the unit table
    links = links.select(*(c.split()[0] for c in _LINK.split(", ")))
    both = cut(links.unionByName(_turned(links)))
    done = vocab.where("exact").select("spelling", "multiplier", F.col("spelling").alias("unit_code"), F.lit("code").alias("how"))
    while True:
        known = done.where("unit_code is not null").join(info, "unit_code").select(F.col("spelling").alias("b"), "quantity", (F.col("logf") + F.log10("multiplier")).alias("b_scale"), (F.col("unit_factor") * F.col("multiplier")).alias("b_factor"), F.col("unit_offset").alias("b_offset"))
        open_ = vocab.join(done.select("spelling"), "spelling", "left_anti")
        mult = F.col("multiplier")
        reached = open_.join(both, F.col("spelling") == F.col("a")).join(known, "b").select(
            "base", "words", "quantity", (F.col("d") + F.col("b_scale") - F.log10(mult)).alias("scale"), "n", "spread",
            (F.col("slope") * F.col("b_factor") / mult).alias("slope"), (F.col("shift") * F.col("b_factor") + F.col("b_offset")).alias("shift"), (F.col("low") * mult).alias("low"), (F.col("high") * mult).alias("high"),
        )
        # links of a base spelling: at most one from each of its spellings to each resolved one
        linked = reached.groupBy("base", "words").agg(F.collect_list(F.struct("quantity", "scale", "n", "spread", "slope", "shift", "low", "high")).alias("found"))
        told = cut(linked.mapInPandas(snapped, "base string, unit_code string, how string").where("unit_code is not null"))
        new = cut(open_.join(told, "base").select("spelling", "multiplier", "unit_code", "how"))
        if new.isEmpty():
            break
        done = cut(done.unionByName(new))
    rest = vocab.join(done.select("spelling"), "spelling", "left_anti")
    word = F.try_element_at("words", F.lit(1))
    return cut(done.unionByName(rest.select("spelling", "multiplier", word.alias("unit_code"), F.when(word.isNotNull(), F.lit("words")).alias("how"))))


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already written) to be broadcast if it has at most ``rows`` rows, else to be joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def scientific(df: DataFrame, column: str, columns: str) -> DataFrame:
    """``column`` (DOUBLE) as text in C's %.4e form; Java rounds the shortest decimal form instead, so this is done over Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(column)
            text = pa.array([None if v is None or v != v else f"{v:.4e}" for v in b.column(at).to_pylist()], pa.string())
            yield b.set_column(at, column, text)

    return df.mapInArrow(run, columns)


def common_amounts(amounts: DataFrame, vocab: DataFrame, units: DataFrame) -> DataFrame:
    """(tab, rec_id, unit, value DOUBLE) of every amount whose unit is known and not already the common one.

    amounts: (tab, rec_id, amount, unit, spelling), ``spelling`` being the text that tells the unit.
    Null amounts and unknown spellings give no row; zero and negative amounts are converted too.
    """
    meaning = vocab.where("unit_code is not null").join(F.broadcast(with_offset(units).select("unit_code", "common_unit", "factor", "offset")), "unit_code").select("spelling", "multiplier", "common_unit", "factor", "offset")
    rows = amounts.where("amount is not null and spelling is not null").join(bounded(cut(meaning)), "spelling")
    rows = rows.where(~F.col("unit").eqNullSafe(F.col("common_unit")))
    return rows.select("tab", "rec_id", F.col("common_unit").alias("unit"), (F.col("amount") * F.col("multiplier") * F.col("factor") + F.col("offset")).alias("value"))


def wrong_factors(pairs: DataFrame, vocab: DataFrame, units: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(tab, rec_id, unit, value DOUBLE) of every pair whose factor is absent or off by more than ``tolerance``.

    pairs: (tab, rec_id, a, b, factor). Both units must be known and of one quantity; unit is the
    code of ``b``, value the right factor. Units with an offset have no factor and no row.
    """
    meaning = cut(vocab.where("unit_code is not null").join(F.broadcast(with_offset(units).where("offset = 0").select("unit_code", "quantity", "factor")), "unit_code").select("spelling", "unit_code", "quantity", (F.col("multiplier") * F.col("factor")).alias("size")))
    side = lambda x: bounded(meaning).select(F.col("spelling").alias(x), F.col("unit_code").alias(f"{x}_code"), F.col("quantity").alias(f"{x}_q"), F.col("size").alias(f"{x}_size"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").where("a_q = b_q").withColumn("right", F.col("a_size") / F.col("b_size"))
    off = F.col("factor").isNull() | F.isnan("factor") | (F.abs(F.col("factor") - F.col("right")) > tolerance * F.col("right"))
    return rows.where(off).select("tab", "rec_id", F.col("b_code").alias("unit"), F.col("right").alias("value"))
