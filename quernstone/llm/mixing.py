"""Selections of documents in which every source has its target share of all tokens.

Budgets go down a tree (mix, domain, source, language): a node's budget is split over its children by
weight, what a child cannot use goes to its siblings, and only what all of them cannot use goes up
to the next ancestor. Each leaf then takes whole epochs of its documents and, of one more epoch, the
longest prefix of the seeded order that the rest of its budget holds; what is still left is filled
from the sizes of the remaining documents, the largest that fits first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.errors import TransformError
from quernstone.session import cut

LEAVES = 100_000  #: (mix, source, language) triples the driver plans for; more are refused
#: A language weighs its tokens to this power unless weights are given, so that small languages are raised.
ALPHA = 0.7
LEVELS = ("domain", "source", "lang")  #: from the mix downwards; the targets are set for sources


@dataclass
class Node:
    """A node of the budget tree; a leaf's capacity is its tokens times the allowed repeats."""

    name: tuple
    weight: float
    capacity: int = 0
    children: list[Node] = field(default_factory=list)
    budget: float = 0.0

    def __post_init__(self) -> None:
        if self.children:
            self.capacity = sum(c.capacity for c in self.children)


def split(node: Node, budget: float) -> None:
    """Gives ``node`` the budget, up to its capacity, and passes it down."""
    node.budget = min(budget, float(node.capacity))
    left, open_ = node.budget, [c for c in node.children if c.capacity > 0]
    given = {id(c): 0.0 for c in open_}
    while open_ and left > 1e-9:
        total = sum(c.weight for c in open_)
        part = {id(c): left * (c.weight / total if total > 0 else 1 / len(open_)) for c in open_}
        full = [c for c in open_ if given[id(c)] + part[id(c)] >= c.capacity]
        if not full:
            for c in open_:
                given[id(c)] += part[id(c)]
            break
        for c in full:  # a full child keeps its capacity; its shortage stays among the siblings
            left -= c.capacity - given[id(c)]
            given[id(c)] = float(c.capacity)
        open_ = [c for c in open_ if c not in full]
    for c in node.children:
        split(c, given.get(id(c), 0.0))


def reachable(sources: list[Node]) -> float:
    """The largest total at which every source that has documents can reach its share."""
    total = sum(s.weight for s in sources if s.capacity > 0)
    return min((s.capacity * total / s.weight for s in sources if s.capacity > 0 and s.weight > 0), default=0.0)


def canonical(c) -> F.Column:
    """A language tag without case and blanks; none is ``und``."""
    t = F.lower(F.trim(c))
    return F.when(t.isNull() | (t == ""), F.lit("und")).otherwise(t)


def tree(mix: str, leaves: list[dict], levels: tuple[str, ...] = LEVELS) -> Node:
    """The budget tree of one mix from (domain, source, lang, share, tokens, capacity, lang_weight) leaves.

    A source weighs its share, a domain the shares of its sources, a language its own weight; below
    another level than its own a source or domain weighs the same, so that the levels may come in
    any order.
    """

    def weight(level: str, rows: list[dict]) -> float:
        if level == "lang":
            return sum(r["lang_weight"] for r in rows)
        return sum({r["source"]: r["share"] for r in rows}.values())

    def grow(name: tuple, weight_: float, rows: list[dict], rest: tuple[str, ...]) -> Node:
        if not rest:
            return Node(name, weight_, sum(r["capacity"] for r in rows))
        groups: dict[str, list[dict]] = {}
        for r in rows:
            groups.setdefault(r[rest[0]], []).append(r)
        return Node(name, weight_, children=[grow((*name, k), weight(rest[0], g), g, rest[1:]) for k, g in sorted(groups.items())])

    return grow((mix,), 1.0, leaves, levels)


def ends(node: Node) -> list[Node]:
    """The leaves below a node."""
    return [x for c in node.children for x in ends(c)] if node.children else [node]


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17, bucket_docs: int = 2_000, domains: dict[str, str] | None = None, languages: dict[str, float] | None = None, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(mix_id, doc_id, source, lang, n_tokens, n_used): the documents of every mix.

    docs: (doc_id, source, lang, n_tokens), doc_id unique; targets: (mix_id, source, target_share,
    max_repeats). total_tokens: the size of every mix; without it each mix gets the largest size at
    which all its shares can be reached. domains: the domain of each source; a source without one is
    a domain of its own. languages: the weight of each language, 0 for others; without it a language
    of a source weighs its tokens to the power ALPHA. levels: the order of the tree's levels.
    n_used is at most max_repeats. Texts without tokens and documents without a source are never
    chosen; a source without documents leaves its share to the others of its domain; null or negative
    shares count as 0, null repeats as 1, repeated targets of a source are added up with the smaller
    repeats. Equal seeds give equal selections.

    bucket_docs: documents of a bucket of the order; prefix sums are made per bucket and over the
    buckets' sums, so no task sees a whole source.
    """
    share = F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))
    t = targets.where("mix_id is not null and source is not null").groupBy("mix_id", "source").agg(F.sum(share).alias("share"), F.greatest(F.min(F.coalesce("max_repeats", F.lit(1))), F.lit(0)).cast("int").alias("repeats"))
    rows = cut(docs.where("n_tokens > 0 and doc_id is not null and source is not null").select("doc_id", "source", canonical(F.col("lang")).alias("lang"), F.col("n_tokens").cast("bigint").alias("n_tokens")))
    sums = rows.groupBy("source", "lang").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    found = t.join(sums, "source").limit(LEAVES + 1).collect()
    if len(found) > LEAVES:
        raise TransformError("too many mixes, sources and languages to plan on the driver")

    by_mix: dict[str, dict[tuple[str, str], dict]] = {}
    for r in found:
        weight = float(r.tokens) ** ALPHA if languages is None else float(languages.get(r.lang, 0.0))
        by_mix.setdefault(r.mix_id, {})[r.source, r.lang] = {**r.asDict(), "domain": (domains or {}).get(r.source, r.source), "capacity": r.tokens * r.repeats if weight > 0 else 0, "lang_weight": weight}
    plan = []
    for mix, leaves in sorted(by_mix.items()):
        root = tree(mix, list(leaves.values()), levels)
        if total_tokens is None:  # that of the sources alone: a language that is short does not lower it
            capacity: dict[str, int] = {}
            for r in leaves.values():
                capacity[r["source"]] = capacity.get(r["source"], 0) + r["capacity"]
            total = reachable([Node((s,), next(r["share"] for r in leaves.values() if r["source"] == s), c) for s, c in sorted(capacity.items())])
        else:
            total = float(total_tokens)
        split(root, total)
        for leaf in ends(root):
            at = dict(zip(levels, leaf.name[1:], strict=True))
            r = leaves[at["source"], at["lang"]]
            whole = min(int(leaf.budget // r["tokens"]), r["repeats"])
            rest = leaf.budget - whole * r["tokens"] if whole < r["repeats"] else 0.0
            plan.append((mix, r["source"], r["lang"], whole, float(rest), int(whole < r["repeats"]), max(1, -(-r["n"] // bucket_docs))))
    spark = docs.sparkSession
    plans = F.broadcast(spark.createDataFrame(plan, "mix_id string, source string, lang string, whole int, rest double, open int, buckets int"))  # at most LEAVES rows

    order = F.xxhash64("doc_id", "mix_id", F.col("whole"), F.lit(seed))
    laid = rows.join(plans, ["source", "lang"]).where("whole > 0 or rest >= 1").withColumn("h", order)
    # equal parts of the order's range, as many as the leaf needs
    laid = laid.withColumn("u", F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)))
    laid = cut(laid.withColumn("bucket", F.least(F.floor(F.col("u") * F.col("buckets")).cast("int"), F.col("buckets") - 1)).drop("buckets"))
    leaf = ["mix_id", "source", "lang"]
    taken = cut(_prefix(laid, leaf))
    more = _filled(taken, leaf)
    out = taken.join(more, ["mix_id", "source", "doc_id"], "left").withColumn("n_used", F.col("whole") + F.col("first") + F.coalesce("now", F.lit(0)))
    return out.where("n_used > 0").select("mix_id", "doc_id", "source", "lang", "n_tokens", "n_used")


def _prefix(laid: DataFrame, leaf: list[str]) -> DataFrame:
    """``laid`` with ``first``, 1 for the longest prefix of every leaf's order that its rest holds.

    Sums of buckets, then, in the one bucket of a leaf where the rest ends, sums of rows.
    """
    parts = laid.groupBy(*leaf, "bucket").agg(F.sum("n_tokens").alias("part"))
    # buckets are summed up in groups of 1024 first, so that no window is long
    inner = cut(parts.withColumn("g", (F.col("bucket") / 1024).cast("int")).withColumn("before", F.sum("part").over(Window.partitionBy(*leaf, "g").orderBy("bucket")) - F.col("part")))
    upper = inner.groupBy(*leaf, "g").agg(F.sum("part").alias("gpart"))
    upper = upper.select(*leaf, "g", (F.sum("gpart").over(Window.partitionBy(*leaf).orderBy("g")) - F.col("gpart")).alias("gbefore"))
    starts = inner.join(upper, [*leaf, "g"]).select(*leaf, "bucket", (F.col("before") + F.col("gbefore")).alias("start"), "part")
    rows = laid.join(starts, [*leaf, "bucket"])
    ends_here = (F.col("start") < F.col("rest")) & (F.col("start") + F.col("part") > F.col("rest"))
    upto = F.col("start") + F.sum("n_tokens").over(Window.partitionBy(*leaf, "bucket").orderBy("h", "doc_id"))
    columns = [*leaf, "doc_id", "n_tokens", "whole", "rest", "open", "u"]
    sure = rows.where(~ends_here).select(*columns, (F.col("start") + F.col("part") <= F.col("rest")).cast("int").alias("first"))
    return sure.unionByName(rows.where(ends_here).withColumn("first", (upto <= F.col("rest")).cast("int")).select(*columns, "first"))


def _filled(taken: DataFrame, leaf: list[str]) -> DataFrame:
    """(mix_id, source, doc_id, now) of the documents that fill what the prefixes left open.

    What the leaves of a source lack is filled from all of its leaves. Only the numbers of documents
    of each size are looked at, sizes below the gap alone, so a source's table is at most as long as
    the longest text. The largest size that fits is taken as often as it fits, then the next; of the
    documents of a size the first of the order are taken.
    """
    top = ["mix_id", "source"]
    gaps = taken.groupBy(*leaf).agg((F.first("rest") - F.sum(F.col("first") * F.col("n_tokens"))).alias("gap")).groupBy(*top).agg(F.sum("gap").alias("gap")).where("gap >= 1")
    free = taken.where("first = 0 and open = 1").join(gaps, top).where("n_tokens <= gap")
    sizes = free.groupBy(*top, "n_tokens").agg(F.count("*").alias("n"), F.first("gap").alias("gap"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        gap, out = float(pdf["gap"].iloc[0]), []
        for size, n in sorted(zip(pdf["n_tokens"].tolist(), pdf["n"].tolist(), strict=True), reverse=True):
            m = min(int(gap // size), n)
            if m:
                out.append((*(pdf[c].iloc[0] for c in top), size, m, n))
                gap -= m * size
        return pd.DataFrame(out, columns=[*top, "n_tokens", "m", "n"])

    wanted = cut(sizes.groupBy(*top).applyInPandas(fill, "mix_id string, source string, n_tokens bigint, m bigint, n bigint"))
    # of many documents of a size only those early in the order are ranked: with m wanted of n, more than enough by chance
    early = F.col("u") <= (F.col("m") + 8 * F.sqrt("m") + 30) / F.col("n")
    near = taken.where("first = 0 and open = 1").join(wanted, [*top, "n_tokens"]).where(early)
    rank = F.row_number().over(Window.partitionBy(*top, "n_tokens").orderBy("u", "doc_id"))
    return near.withColumn("k", rank).where("k <= m").select(*top, "doc_id", F.lit(1).alias("now"))


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, actual_share, tokens, n_docs, most_used, max_repeats) of every target."""
    got = selection.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("n_used")).alias("tokens"), F.count("*").alias("n_docs"), F.max("n_used").alias("most_used"))
    total = got.groupBy("mix_id").agg(F.sum("tokens").alias("all_tokens"))
    t = targets.select("mix_id", "source", "target_share", "max_repeats")
    out = t.join(got, ["mix_id", "source"], "left").join(total, "mix_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("mix_id", "source", "target_share", F.round(zero("tokens") / F.col("all_tokens"), 6).alias("actual_share"), zero("tokens").alias("tokens"), zero("n_docs").alias("n_docs"), zero("most_used").alias("most_used"), "max_repeats")
