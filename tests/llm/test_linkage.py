import random

import numpy as np
import pytest

from quernstone.llm import linkage as lk

S = "id bigint, name string, category string, sub string, cas string, linked string"
T = "id bigint, code string, name string, synonyms array<string>, cas string, categories array<string>"


def slow_distance(a, b):
    d = {(-1, -1): 0}
    for i in range(-1, len(a)):
        for j in range(-1, len(b)):
            if i < 0 or j < 0:
                d[i, j] = max(i, j) + 1
                continue
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_distance_against_brute_force():
    r = random.Random(1)
    for _ in range(400):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(2))
        assert lk.distance(a, b) == slow_distance(a, b), (a, b)


@pytest.mark.parametrize("text, want", [("Acid, praruvic", ("praruvic acid", "")), ("Ore of Droquiite, 11 % in rock", ("droquiite ore 11 in rock", "")), ("Kelploane, in process gas", ("kelploane", "")), ("X (unspecified origin)", ("x", "")), ("Drotor. deriv.", ("", "drotor")), ("nan", ("", "")), (None, ("", "")), ("2, 4 dichloro  dal", ("2 4 dichloro dal", ""))])
def test_names(text, want):
    assert lk.name_parts(text) == want


@pytest.mark.parametrize("text, want", [("009905265-83-3", "9905265833"), ("CAS 9905265-83-3", "9905265833"), ("000000-00-0", None), ("-", None), (None, None)])
def test_registry(text, want):
    assert lk.registry(text) == want


@pytest.mark.parametrize("category, sub, cats", [("to air", "city air", "Releases to air, urban air close to ground"), ("Luft", None, "Releases to air, unspecified"), ("rejet dans l'eau", "Fluss", "Releases to water, fresh water"), ("Soil emissions", "Acker", "Releases to soil, agricultural soil"), ("from nature", "lithosphere", "Resources from environment, non-renewable from ground"), ("to water", "ground-", "Releases to water, ground water")])
def test_places_without_links_follow_the_lists(spark, category, sub, cats):
    every = ["Releases to air, urban air close to ground", "Releases to air, unspecified", "Releases to water, fresh water", "Releases to soil, agricultural soil", "Resources from environment, non-renewable from ground", "Releases to water, ground water"]
    targets = spark.createDataFrame([lk.target_place(["E", c.split(",")[0], c]) for c in every], "t_place string, known array<string>")
    place = spark.createDataFrame([(lk.source_place(category, sub),)], "place string")
    got = lk.learned_places(place, spark.createDataFrame([], "place string, t_place string, n bigint"), targets).where("rank = 1").first()
    assert got.t_place == lk.words(cats) and got.post > 0.5


PLACES = {"air": "Releases to air, unspecified", "river": "Releases to water, fresh water", "field": "Releases to soil, agricultural soil"}
#: What sources call the places: words of no list, among them some that single rows use.
CALLED = {"air": [("vazduh", "opste"), ("zrak", None), ("ilma", "yleinen"), ("aria", "generale")], "river": [("voda", "reka"), ("vesi", "joki"), ("agua", "rio"), ("uisce", "abhainn")], "field": [("zemlja", "njiva"), ("maa", "pelto"), ("suelo", "campo"), ("talaj", "mezo")]}


def world(seed=4, n=160, rows=1500):
    r = random.Random(seed)
    syl = ["bel", "dro", "kas", "lum", "nep", "tor", "vith", "xan", "zol", "quis"]
    names = sorted({"".join(r.choice(syl) for _ in range(4)) + r.choice(["ane", "ide", "ol", "ate"]) for _ in range(n)})
    cas = {n: f"99{i:05d}-11-1" for i, n in enumerate(names)}
    pairs = [(n, p) for i, n in enumerate(names) if i % 5 for p in PLACES if r.random() < 0.8]
    targets = [(10_000 + i, f"c{i}", n, None, cas[n] if r.random() < 0.7 else None, ["E", PLACES[p].split(",")[0], PLACES[p]]) for i, (n, p) in enumerate(pairs)]
    known = {pair: t for pair, t in zip(pairs, targets, strict=True)}
    sources, truth = [], {}
    for i in range(rows):
        name, p = r.choice(names), r.choice(sorted(PLACES))
        k = r.randrange(1, len(name) - 1)
        typed = r.choice([name, name.upper(), name[:k] + name[k + 1 :], name[:k] + name[k + 1] + name[k] + name[k + 2 :], f"{name}, technical grade"])
        t = known.get((name, p))
        category, sub = r.choice(CALLED[p])
        sources.append((i, typed, category, sub, cas[name] if t and r.random() < 0.5 else None, t[1] if t and r.random() < 0.5 else None))
        if t:
            truth[i] = t[0]
    return sources, targets, truth


def test_held_out_accuracy_with_places_that_only_the_links_tell(spark):
    sources, targets, truth = world()
    got = {r.id: r.target_id for r in lk.match(spark.createDataFrame(sources, S).selectExpr("*", "1 AS s", "2 AS p"), spark.createDataFrame(targets, T)).collect()}
    open_ = {s[0] for s in sources if s[5] is None}
    assert set(got) <= open_
    right = sum(truth.get(i) == t for i, t in got.items())
    assert right / len(got) > 0.97
    assert right / len([i for i in open_ if i in truth]) > 0.93


def blocked(spark, sources, targets):
    """(s, t) pairs that blocking reaches, targets that stand for others expanded."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(sources, S).withColumnRenamed("id", "s")
    s, t = lk.classes(rows.select("s", "name", "category", "sub", "cas"), spark.createDataFrame(targets, T))
    truth = rows.join(spark.createDataFrame(targets, T).select(F.col("code").alias("linked"), F.col("id").alias("right")), "linked").select("s", "right")
    at = t.select(F.col("t").alias("right"), F.col("place").alias("t_place"))
    links = truth.join(s.select("s", "place"), "s").join(at, "right").groupBy("place", "t_place").agg(F.count("*").alias("n"))
    where = lk.learned_places(s.select("place").distinct(), links, t.groupBy(F.col("place").alias("t_place")).agg(F.first("known").alias("known"))).cache()
    pairs = lk.candidates(s, t, where).cache()
    found = s.select("s", "a", "place").join(pairs, "a").join(t.select("t", "b", F.col("place").alias("t_place")), "b").join(where, ["place", "t_place"])
    return pairs, {(r.s, r.t) for r in found.select("s", "t").collect()}


def test_blocking_recall_over_several_compartments(spark):
    sources, targets, truth = world(seed=9, rows=600)
    _, found = blocked(spark, sources, targets)
    assert sum((i, truth[i]) in found for i in truth) / len(truth) > 0.95


def test_a_hot_name_costs_rows_not_their_square(spark):
    counts = []
    for n in (100, 200, 400):
        sources = [(i, "belanekastor", f"air {i % 7}", None, f"99{i:05d}-11-1", None) for i in range(n)]
        targets = [(10_000 + i, f"c{i}", "belanekastor", None, f"99{i:05d}-11-1", ["E", "Releases to air", "Releases to air, unspecified"]) for i in range(n)]
        pairs, found = blocked(spark, sources, targets)
        counts.append(pairs.count())
        assert all((i, 10_000 + i) in found for i in range(n))  # that of its own number is among them
    assert counts[1] <= 2.2 * counts[0] and counts[2] <= 2.2 * counts[1] and counts[2] <= 4 * 400


def test_odd_rows_and_empty_tables(spark):
    targets = spark.createDataFrame([(1, "c1", "belane", None, None, ["E", "Releases to air", "Releases to air, unspecified"]), (2, "c2", "belane", None, None, ["E", "Releases to air", "Releases to air, unspecified"]), (3, "c3", None, None, None, None)], T)
    rows = [(1, "belane", "to air", None, None, None), (2, "belane", "to air", None, None, None), (3, None, None, None, None, None), (4, "belane", "to water", None, None, None), (5, "x" * 50_000, "to air", None, None, None)]
    got = {r.id: r.target_id for r in lk.match(spark.createDataFrame(rows, S), targets, least_p=0.5).collect()}
    assert {k: v for k, v in got.items() if k in (1, 2)} == {1: 1, 2: 1}  # two equal targets: the smaller id
    assert not {3, 5} & set(got)
    assert lk.match(spark.createDataFrame([], S), targets).count() == 0
    assert lk.match(spark.createDataFrame(rows, S), targets.limit(0)).count() == 0


def test_calibration():
    r = np.random.default_rng(0)
    x = r.random((4000, len(lk.FEATURES)))
    y = (r.random(4000) < 1 / (1 + np.exp(-8 * (x[:, 1] - 0.5)))).astype(float)
    p = lk.Model(x, y, np.arange(4000)).probability(x)
    for lo, hi in ((0.2, 0.4), (0.4, 0.6), (0.6, 0.8)):
        part = (p > lo) & (p < hi)
        assert abs(p[part].mean() - y[part].mean()) < 0.08


def test_cut_off_names_of_any_length(spark):
    long = "".join(f"syl{i}" for i in range(30))
    members = spark.createDataFrame([(f"{long} oxide", "air", 1), (f"{long} ide", "sea", 2), (f"{long} ane", "sea", 3), ("lumane", "air", 4), ("lum ane", "air", 5), ("dro", "air", 6)], "t_name string, place string, b bigint")
    stems = spark.createDataFrame([(long,), (f"{long}id",), ("lum",), ("dromedane",)], "stem string")
    assert {tuple(r) for r in lk.stem_pairs(stems, members).collect()} == {(long, "air", 1), (f"{long}id", "sea", 2), ("lum", "air", 4)}
    assert lk.stem_pairs(stems.limit(0), members).count() == 0
