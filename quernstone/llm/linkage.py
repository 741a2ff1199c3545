"""Records of two tables that describe the same things, matched without a common key.

Both sides fall into classes: names, substances (names and registry number) and places. Blocking
works on distinct names alone: two names become a pair if they share a MinHash band (character
trigrams without the over-frequent ones) or if a cut-off name is the start of one name only; equal
registry numbers are the other way. A class of targets that a pair reaches is stood for by one
member for each place and by the one of the same registry number, so a name that many records share
costs rows, not their square. What a source calls a place is learned from rows that are linked
already (naive Bayes over the words of its compartment fields) and becomes a feature, like the
similarity of names and numbers. A logistic classifier trained on linked rows (weak labels) weighs
the features, its probabilities are calibrated on links held out, and the best candidate of a row
is its match.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.keys import key
from quernstone.session import cut, spread

BANDS, BAND_ROWS, GRAM = 24, 3, 3
STOP_SHARE = 0.03  #: a trigram of more than this share of the target names blocks nothing
LEAST_P = 0.5  #: a match needs this probability
#: Places of a row that its candidates may lie in: those of this posterior, and the best two in any case.
LEAST_PLACE = 0.02
ELSEWHERE = 0.5  #: what the similarity of a candidate in a less likely place counts for when leads are taken
SMOOTH, KNOWN = 0.05, 5.0  #: pseudo-counts of a word in a place, and of what the word lists below say

#: Words for compartments and their parts; a prior where links tell nothing yet.
COMPARTMENTS = {
    "air": ["air", "luft", "l air"],
    "water": ["water", "wasser", "l eau", "eau"],
    "soil": ["soil", "boden", "le sol", "sol"],
    "resource": ["resource", "resources", "ressourcen", "ressource", "raw materials", "from nature", "nature"],
}
SUBCOMPARTMENTS = {
    "unspecified": ["", "unspecified", "not specified", "n s", "ns"],
    "urban": ["urban", "city air", "high population density", "high pop", "urban air close to ground"],
    "rural": ["rural", "non urban", "low population density", "low pop", "non urban air or from high stacks rural"],
    "indoor": ["indoor", "inside buildings", "innenraum", "indoor air"],
    "stack": ["high stack", "stack 150 m", "chimney", "very high stack"],
    "fresh": ["river", "fluss", "fresh water river", "fresh water"],
    "sea": ["sea", "ocean", "meer", "salt water", "sea water"],
    "ground water": ["groundwater", "grundwasser", "ground", "aquifer", "ground water"],
    "agricultural": ["agricultural", "arable", "acker", "farm land", "agricultural soil"],
    "industrial": ["industrial", "industrie", "industry site", "industrial soil"],
    "forest": ["forest", "forestry", "wald", "forest soil"],
    "in ground": ["in ground", "ground", "lithosphere", "non renewable from ground"],
    "biotic": ["biotic", "living", "biomass stock", "renewable biotic"],
}


def words(text: str | None) -> str:
    """Lower-case words without accents and signs, single spaces."""
    s = unicodedata.normalize("NFKD", text or "")
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    return " ".join(re.findall(r"[a-z0-9]+", s))


def _none(text) -> bool:
    return text is None or text != text or str(text).strip().lower() in ("", "nan", "none", "<na>")


_COMP = {w: c for c, ws in COMPARTMENTS.items() for w in ws}


def compartment(text: str | None) -> str:
    s = " " + words(None if _none(text) else text) + " "
    for w in sorted(_COMP, key=len, reverse=True):
        if f" {w} " in s:
            return _COMP[w]
    return ""


def part(text: str | None, comp: str) -> str:
    """The part of a compartment; an unknown word stands for itself."""
    s = words(None if _none(text) else text)
    s = re.sub(rf"^(?:releases to|emission to|resources from)?\s*(?:{comp}|environment)\s+", "", s).strip() if s else s
    for name, forms in SUBCOMPARTMENTS.items():
        if s in forms and (name, comp) not in (("in ground", "water"), ("ground water", "resource")):
            return name
    return s


def source_place(category: str | None, sub: str | None) -> str:
    """Both fields as words, parted by a bar; a missing field is empty."""
    return "|".join(words(None if _none(x) else x) for x in (category, sub))


def place_tokens(category: str, sub: str) -> list[str]:
    """What the place of a description is recognised by: its fields, their words, and what the lists say of them."""
    comp = compartment(category)
    known = [f"list:{comp}", f"list:{comp}/{part(sub, comp)}"] if comp else []
    return list(dict.fromkeys(["any", f"both:{category}|{sub}", f"category:{category}", f"part:{sub}", *(f"word:{w}" for w in f"{category} {sub}".split()), *known]))


def target_place(categories) -> tuple[str, list[str]]:
    """(last category as words, the tokens of the lists that speak for it)."""
    cats = [c for c in (categories if categories is not None else []) if c]
    if not cats:
        return "", []
    comp = compartment(cats[1] if len(cats) > 1 else cats[0])
    last = cats[-1].split(",", 1)[1] if "," in cats[-1] else ""
    return words(cats[-1]), [f"list:{comp}", f"list:{comp}/{part(last, comp)}"] if comp else []


def registry(text: str | None) -> str | None:
    """Digits of a registry number without leading zeros; zeros and too short numbers are none."""
    if _none(text):
        return None
    digits = re.sub(r"\D", "", text).lstrip("0")
    return digits if len(digits) >= 5 else None


def name_parts(text: str | None) -> tuple[str, str]:
    """(name in plain order without qualifiers, stem of a cut-off name or '')."""
    if _none(text):
        return "", ""
    s = " ".join(unicodedata.normalize("NFKC", text).split())
    if m := re.fullmatch(r"(\S{3,})\.\s+\w+\.?", s):
        return "", words(m[1]).replace(" ", "")
    s = re.sub(r"\s*\([^)]*\)\s*$", "", s)
    if m := re.match(r"(?i)(acid|ore)(?: of|,)\s+(.+)$", s):
        head, comma, tail = m[2].partition(",")
        s = f"{head} {m[1]}{comma}{tail}" if re.match(r"(?i)ore", m[1]) else f"{m[2]} {m[1]}"
    s = re.sub(r",\s+[A-Za-z][A-Za-z ]*$", "", s)
    return words(s), ""


def grams(name: str) -> list[str]:
    s = f" {name.replace(' ', '')} "
    return [s[i : i + GRAM] for i in range(len(s) - GRAM + 1)]


_RNG = np.random.default_rng(11)
_A = _RNG.integers(1, (1 << 31) - 1, BANDS * BAND_ROWS, dtype=np.int64)
_B = _RNG.integers(0, (1 << 31) - 1, BANDS * BAND_ROWS, dtype=np.int64)


def bands(name: str, stop: set[str]) -> list[int]:
    """Band hashes of the MinHash signature; a name of over-frequent trigrams only keeps them all."""
    g = set(grams(name))
    h = np.array([crc32(x.encode()) & 0x7FFFFFFF for x in (g - stop or g)], np.int64)
    low = ((h[:, None] * _A + _B) % ((1 << 31) - 1)).min(0).reshape(BANDS, BAND_ROWS)
    mixed = (low[:, 0] * 1_000_003 ^ low[:, 1]) * 1_000_003 ^ low[:, 2]
    return [int(x) for x in (mixed * 31 + np.arange(BANDS)) & 0x7FFFFFFFFFFF]


def distance(a: str, b: str) -> int:
    """Edit distance with swaps of neighbours, bit-parallel."""
    if a == b or not a or not b:
        return 0 if a == b else len(a) + len(b)
    mask: dict[str, int] = {}
    for i, c in enumerate(a):
        mask[c] = mask.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    vp, vn, d0, last, score = full, 0, 0, 0, len(a)
    for c in b:
        pm = mask.get(c, 0)
        swap = ((~d0 & pm) << 1) & last
        d0 = (((pm & vp) + vp) ^ vp) | pm | vn | swap
        hp, hn = vn | ~(d0 | vp), d0 & vp
        score += bool(hp & top) - bool(hn & top)
        hp = (hp << 1) | 1
        vp, vn, last = ((hn << 1) | ~(d0 | hp)) & full, hp & d0 & full, pm
        d0 &= full
    return score


FEATURES = ["exact", "similar", "edits", "same_end", "numbers_differ", "start_of", "cas_equal", "cas_differ", "cas_absent", "place", "place_best", "gap", "lone"]
NAME_FEATURES = 9  #: the first ones tell of names and numbers alone


def _ending(name: str) -> str:
    last = name.split(" ")[-1] if name else ""
    return re.sub(r"\d+$", "", last).rstrip("e")[-3:]


def compare(name: str, stem: str, cas: str | None, names: list[str], t_cas: str | None) -> list[float]:
    """Similarity of one description and one target; the target's best-fitting name counts."""
    best = (0.0, 99.0, 0.0, 0.0, 1.0)
    flat = name.replace(" ", "")
    for other in names:
        o = other.replace(" ", "")
        if flat:
            d = distance(flat, o)
            got = (1 - d / max(len(flat), len(o), 1), float(d), float(_ending(name) == _ending(other)), float(re.findall(r"\d+", name) != re.findall(r"\d+", other)), 0.0)
        else:
            hit = bool(stem) and o.startswith(stem)
            got = (0.6 if hit else 0.0, 9.0, 0.0, 0.0, float(hit))
        if got[0] > best[0] or best[1] == 99.0:
            best = got
    sim, d, end, digits, start = best
    return [float(sim == 1.0), sim, min(d, 10.0) / 10, end, digits, start if not flat else 0.0, float(bool(cas) and cas == t_cas), float(bool(cas) and bool(t_cas) and cas != t_cas), float(not cas or not t_cas)]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 3.0, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps; weights of the features and, last, the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def expand(x: np.ndarray) -> np.ndarray:
    """Features and their products, so that a logistic model can weigh names by registry numbers."""
    k = x.shape[1]
    return np.column_stack([x, *(x[:, i] * x[:, j] for i in range(k) for j in range(i + 1, k))])


def knocked_out(x: np.ndarray, y: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The examples, and once more those of every linked row without its right target.

    Linked rows always have a target, open ones may have none. The second set shows the classifier
    what the best candidate of such a row looks like: its lead over the others is told anew.
    """
    sim, best, gap, lone = (FEATURES.index(f) for f in ("similar", "place_best", "gap", "lone"))
    order = np.argsort(group, kind="stable")
    wrong = order[y[order] == 0]
    again, g = x[wrong].copy(), group[wrong]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.array([], int)
    for a, b in zip(starts, np.r_[starts[1:], len(g)], strict=False):
        v = again[a:b, sim] * np.where(again[a:b, best] == 1, 1.0, ELSEWHERE)
        top = np.sort(v)[::-1]
        again[a:b, gap] = [s - (top[1] if s == top[0] and len(top) > 1 else 0.0 if s == top[0] else top[0]) for s in v]
        again[a:b, lone] = float(len(v) == 1)
    return np.vstack([x, again]), np.concatenate([y, np.zeros(len(again))]), np.concatenate([group, g])


#: Weights where too few links exist to learn from: an exact name, or a close one that no registry number contradicts.
PRIOR = dict(zip(FEATURES, [3.0, 14.0, -6.0, 2.0, -8.0, 3.0, 5.0, -5.0, 0.0, 6.0, 2.0, 2.0, 0.0], strict=True))
PRIOR_BIAS = -14.0


class Model:
    """The classifier with its calibration."""

    def __init__(self, x: np.ndarray, y: np.ndarray, group: np.ndarray, least: int = 60) -> None:
        self.w, self.slope, self.shift = None, 1.0, 0.0
        if y.sum() >= least and (1 - y).sum() >= least:
            held = group % 4 == 0
            self.w = fit(expand(x[~held]), y[~held])
            platt = fit(self.raw(x[held])[:, None], y[held], ridge=0.01)
            self.slope, self.shift = max(float(platt[0]), 0.05), float(platt[1])

    def raw(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return x @ np.array([PRIOR[f] for f in FEATURES]) + PRIOR_BIAS
        return np.column_stack([expand(x), np.ones(len(x))]) @ self.w

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def described(df: DataFrame) -> DataFrame:
    """(s, name, stem, cas, place) of sources (s, name, category, sub, cas)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [name_parts(n) for n in b["name"]]
            yield pd.DataFrame({"s": b["s"], "name": [p[0] for p in parts], "stem": [p[1] for p in parts], "cas": [registry(c) for c in b["cas"]], "place": [source_place(c, x) for c, x in zip(b["category"], b["sub"], strict=True)]})

    return df.select("s", "name", "category", "sub", "cas").mapInPandas(run, "s bigint, name string, stem string, cas string, place string")


def substances(df: DataFrame) -> DataFrame:
    """(t, names, cas, place, known) of targets (id, name, synonyms, cas, categories)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names = []
            for n, more in zip(b["name"], b["synonyms"], strict=True):
                every = [name_parts(x)[0] for x in [n, *(more if more is not None else [])]]
                names.append(list(dict.fromkeys(x for x in every if x)))
            places = [target_place(c) for c in b["categories"]]
            yield pd.DataFrame({"t": b["id"], "names": names, "cas": [registry(c) for c in b["cas"]], "place": [p for p, _ in places], "known": [k for _, k in places]})

    return df.select("id", "name", "synonyms", "cas", "categories").mapInPandas(run, "t bigint, names array<string>, cas string, place string, known array<string>")


def _banded(names: DataFrame, stop: set[str], side: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(n, k) for n in b["name"] for k in bands(n, stop)]
            yield pd.DataFrame(out, columns=[side, "band"])

    return names.select("name").mapInPandas(run, f"{side} string, band bigint")


def stop_grams(targets: DataFrame) -> set[str]:
    """targets: (name), distinct. Trigrams of more than STOP_SHARE of the target names: at most (trigrams of a name) / STOP_SHARE of them."""
    each = targets.select(F.col("name").alias("n"))
    n = each.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": [g for x in b["n"] for g in set(grams(x))]}, columns=["g"])

    counts = each.mapInPandas(run, "g string").groupBy("g").agg(F.count("*").alias("c"))
    return {r.g for r in counts.where(F.col("c") > max(STOP_SHARE * n, 20)).collect()}


def name_pairs(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct (name, t_name) of distinct names that share a band; equal names always do."""
    stop = stop_grams(targets)
    return _banded(sources, stop, "name").join(_banded(targets, stop, "t_name"), "band").select("name", "t_name").distinct()


def stem_pairs(stems: DataFrame, members: DataFrame) -> DataFrame:
    """(stem, place, b) of cut-off names that one name of a place alone begins with.

    stems: (stem), distinct, of any length; members: (t_name, place, b). Names are cut to the lengths
    that stems have, one row of an aggregate.
    """
    lens = stems.agg(F.collect_set(F.length("stem")).alias("lens"))
    flat = members.select("place", "b", F.regexp_replace("t_name", " ", "").alias("flat")).crossJoin(F.broadcast(lens))
    starts = F.transform(F.filter("lens", lambda n: n <= F.length("flat")), lambda n: F.substring("flat", F.lit(1), n))
    begun = flat.select("place", "b", "flat", F.explode(starts).alias("stem")).join(stems, "stem")
    lone = begun.groupBy("stem", "place").agg(F.count_distinct("flat").alias("k"), F.min("b").alias("b"))
    return lone.where("k = 1").select("stem", "place", "b")


def learned_places(places: DataFrame, links: DataFrame, targets: DataFrame) -> DataFrame:
    """(place, t_place, post, rank): where descriptions of a place point, by naive Bayes over its tokens.

    places: (place), distinct; links: (place, t_place, n), counted over all links; targets:
    (t_place, known), distinct. Every place has the token ``any``, so one that no link or list knows
    gets the shares of the links.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"place": b["place"], "tokens": [place_tokens(*p.split("|", 1)) for p in b["place"]]})

    tokens = cut(places.mapInPandas(split, "place string, tokens array<string>"))
    seen = links.join(tokens, "place").select("t_place", "n", F.explode("tokens").alias("token"))
    listed = targets.select("t_place", F.lit(KNOWN).alias("n"), F.explode(F.concat("known", F.array(F.lit("any")))).alias("token"))
    counts = cut(seen.select("t_place", F.col("n").cast("double"), "token").unionByName(listed).groupBy("token", "t_place").agg(F.sum("n").alias("n")))
    totals = counts.where("token = 'any'").select("t_place", F.col("n").alias("total"))
    words_ = counts.select(F.count_distinct("token").alias("v"))  # one row
    told = tokens.select("place", F.size("tokens").alias("k"), F.explode("tokens").alias("token")).join(counts, "token")
    bits = told.groupBy("place", "t_place").agg(F.sum(F.log1p(F.col("n") / SMOOTH)).alias("got"), F.first("k").alias("k")).join(F.broadcast(words_)).join(totals, "t_place")
    value = F.log("total") + F.col("got") + F.col("k") * F.log(F.lit(SMOOTH) / (F.col("total") + SMOOTH * F.col("v")))
    w = Window.partitionBy("place")
    out = bits.select("place", "t_place", value.alias("value")).withColumn("top", F.max("value").over(w)).withColumn("post", F.exp(F.col("value") - F.col("top")))
    out = out.withColumn("post", F.col("post") / F.sum("post").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("value"), "t_place")))
    return out.where(f"post >= {LEAST_PLACE} or rank <= 2").select("place", "t_place", "post", "rank")


def candidates(s: DataFrame, t: DataFrame, where: DataFrame) -> DataFrame:
    """Distinct (a, b) of description classes and substances.

    s: (a, name, stem, cas, place); t: (t, b, names, cas, place); where: what :func:`learned_places`
    gives. For each pair of names the substances of that name are stood for by one of each place
    that the description may point to - one without a registry number, else the least - and by that
    of its own registry number.
    """
    members = cut(t.select("b", "cas", "place", F.explode("names").alias("t_name")).distinct())
    rest = F.struct(F.col("cas").isNotNull(), F.col("b"))
    by_place = members.groupBy("t_name", F.col("place").alias("t_place")).agg(F.min_by("b", rest).alias("b"))
    by_cas = t.where("cas is not null").groupBy("cas", F.col("place").alias("t_place")).agg(F.min("b").alias("b"))
    same_cas = members.where("cas is not null").groupBy("t_name", "cas", F.col("place").alias("t_place")).agg(F.min("b").alias("b"))
    pairs = cut(name_pairs(spread(cut(s.where("name != ''").select("name").distinct()), 5_000), cut(members.select(F.col("t_name").alias("name")).distinct())))
    placed = cut(s.select("a", "name", "stem", "cas", "place").distinct().join(where.select("place", "t_place"), "place").select("a", "name", "stem", "cas", "t_place").distinct())
    named = placed.where("name != ''").join(pairs, "name")
    found = named.join(by_place, ["t_name", "t_place"]).select("a", "b")
    found = found.unionByName(named.join(same_cas, ["t_name", "cas", "t_place"]).select("a", "b"))
    found = found.unionByName(placed.where("cas is not null").join(by_cas, ["cas", "t_place"]).select("a", "b"))
    stems = stem_pairs(s.where("stem != ''").select("stem").distinct(), members).withColumnRenamed("place", "t_place")
    return found.unionByName(placed.where("stem != ''").join(stems, ["stem", "t_place"]).select("a", "b")).distinct()


def features(pairs: DataFrame, s: DataFrame, t: DataFrame, where: DataFrame) -> DataFrame:
    """(s, t, x) of the candidates that any name or registry number speaks for."""
    left = s.groupBy("a").agg(*(F.first(c).alias(c) for c in ("name", "stem", "cas")))
    right = t.groupBy("b").agg(F.first("names").alias("t_names"), F.first("cas").alias("t_cas"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "name", "stem", "cas", "t_names", "t_cas")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [compare(r.name, r.stem, r.cas, list(r.t_names), r.t_cas) for r in b.itertuples(index=False)]
            out = pd.DataFrame({"a": b["a"], "b": b["b"], "x": x})
            keep = [v[1] >= 0.5 or v[6] > 0 for v in x]
            yield out[pd.Series(keep, index=out.index, dtype=bool)]

    alike = cut(spread(cut(both), 20_000).mapInPandas(run, "a bigint, b bigint, x array<double>"))
    member = t.groupBy("b", F.col("place").alias("t_place")).agg(F.min("t").alias("t"))
    rows = s.select("s", "a", "place").join(alike, "a").join(member, "b").join(where, ["place", "t_place"])
    sim = F.col("x")[1]
    place = F.array(F.greatest(F.log("post"), F.lit(-8.0)) / 8, (F.col("rank") == 1).cast("double"))
    # how far a candidate leads the row's best other one; a place that is less likely counts for less
    rows = rows.groupBy("s", "t").agg(F.max(F.struct(sim.alias("v"), F.col("x"), place.alias("at"))).alias("m")).select("s", "t", F.col("m.x").alias("x"), F.col("m.at").alias("at"), (F.col("m.v") * F.when(F.col("m.at")[1] == 1, 1.0).otherwise(ELSEWHERE)).alias("v"))
    w = Window.partitionBy("s").orderBy(F.desc("v"), F.desc(F.col("x")[6]), "t")
    all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top, second = F.first("v").over(all_), F.nth_value("v", 2).over(all_)
    rows = rows.select("s", "t", "x", "at", "v", F.row_number().over(w).alias("k"), top.alias("top"), second.alias("second"))
    gap = F.when(F.col("k") == 1, F.col("v") - F.coalesce("second", F.lit(0.0))).otherwise(F.col("v") - F.col("top"))
    return rows.select("s", "t", F.concat("x", "at", F.array(gap, F.col("second").isNull().cast("double"))).alias("x"))


def classes(sources: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Descriptions (s, a, ...) and targets (t, b, ...) with their classes."""
    name = lambda *cs: F.xxhash64(*(F.coalesce(c, F.lit("\x00")) for c in cs))
    s = cut(described(spread(cut(sources), 10_000)).withColumn("a", name("name", "stem", "cas")))
    t = cut(substances(targets).withColumn("b", name(F.array_join(F.array_sort("names"), "\x01"), "cas")))
    return s, t


def match(sources: DataFrame, targets: DataFrame, train_rows: int = 20_000, least_p: float = LEAST_P) -> DataFrame:
    """(id, target_id, confidence): the match of every open row that has one.

    sources: (id, name, category, sub, cas, linked) with ``linked`` the target's code where the row
    is linked already, else null; targets: (id, code, name, synonyms, cas, categories). Rows with
    neither a name nor a registry number have no match; equal rows get equal matches; of equally
    good targets the one with the smaller id wins. Null columns count as absent, empty tables give
    an empty result, other columns are ignored.

    train_rows: linked descriptions the classifier learns from, a bounded sample by hash order. With
    too few links fixed weights are used.
    """
    cols = ["name", "category", "sub", "cas"]
    digest = F.xxhash64(*(F.coalesce(c, F.lit("\x00")) for c in cols))
    rows = cut(sources.select("id", *cols, key(F.col("linked")).alias("linked"), digest.alias("s")))
    # equal descriptions are matched once
    want = cut(rows.groupBy("s").agg(*(F.first(c).alias(c) for c in cols), F.max(F.col("linked").isNull()).alias("open"), F.min("linked").alias("linked")))
    s, t = classes(want.select("s", *cols), targets)
    truth = cut(want.where("linked is not null").select("s", "linked").join(targets.groupBy(key(F.col("code")).alias("linked")).agg(F.min("id").alias("right")), "linked").select("s", "right"))

    at = t.select(F.col("t").alias("right"), F.col("place").alias("t_place"))
    links = truth.join(s.select("s", "place"), "s").join(at, "right").groupBy("place", "t_place").agg(F.count("*").alias("n"))
    where = cut(learned_places(s.select("place").distinct(), links, t.groupBy(F.col("place").alias("t_place")).agg(F.first("known").alias("known"))))

    # the classifier learns from a bounded sample of the links; the others that are not open have their answer
    n = truth.count()
    share = F.shiftrightunsigned(F.xxhash64("s", F.lit(5)), 11) / F.lit(float(1 << 53))
    sample = truth.where(share < train_rows / n) if n > train_rows else truth
    used = cut(s.join(want.where("open").select("s").unionByName(sample.select("s")).distinct(), "s"))
    scored = cut(features(candidates(used, t, where), used, t, where))

    learn = scored.join(sample, "s").select("s", "x", (F.col("t") == F.col("right")).cast("int").alias("y")).toPandas()  # candidates of about train_rows rows
    x = np.array(learn["x"].tolist(), float).reshape(-1, len(FEATURES))
    model = Model(*knocked_out(x, learn["y"].to_numpy(float), learn["s"].to_numpy(np.int64)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = model.probability(np.array(b["x"].tolist(), float).reshape(-1, len(FEATURES)))
            yield pd.DataFrame({"s": b["s"], "t": b["t"], "p": p})

    best = scored.mapInPandas(judge, "s bigint, t bigint, p double").groupBy("s").agg(F.max(F.struct("p", (-F.col("t")).alias("minus"))).alias("b")).where(F.col("b.p") >= least_p)
    return rows.where("linked is null").join(best, "s").select("id", (-F.col("b.minus")).alias("target_id"), F.round("b.p", 4).alias("confidence"))
