import random

import pytest
from pyspark.sql import functions as F

from quernstone.errors import DedupError
from quernstone.operators import assemble, checks, dedup, infer, resolve, shard

ROWS = "iri string, pref_label string, n int, ord bigint"


def test_intra_collapses_equal_rows_and_raises_on_conflicts(spark):
    df = spark.createDataFrame([("a", "x", 1, 0), ("a", "x", 1, 1), (None, "y", 2, 2), (None, "y", 2, 3)], ROWS)
    assert sorted((r.iri or "", r.ord) for r in dedup.intra(df).collect()) == [("", 2), ("", 3), ("a", 0)]
    with pytest.raises(DedupError, match="a"):
        dedup.intra(df.unionByName(spark.createDataFrame([("a", "z", 1, 4)], ROWS)))
    assert dedup.intra(df.limit(0)).count() == 0


def test_first_wins_against_brute_force(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice("xyz"), r.randrange(9), i) for i in range(300)]
    r.shuffle(rows)
    got = {(x.iri, x.pref_label): x.n for x in dedup.first_wins(spark.createDataFrame(rows, ROWS), ["iri", "pref_label"]).collect()}
    want = {}
    for iri, label, n, _ in sorted(rows, key=lambda x: x[3]):
        want.setdefault((iri, label), n)
    assert got == want


def test_first_wins_of_arrays_and_ties(spark):
    df = spark.createDataFrame([("a", ["x"], {"k": "v"}, 1), ("a", ["y"], {"k": "w"}, 1)], "iri string, v array<string>, m map<string,string>, ord bigint")
    assert dedup.first_wins(df, ["iri"]).collect() == dedup.first_wins(df.orderBy(F.desc("v")), ["iri"]).collect()


def test_label_collisions(spark):
    df = spark.createDataFrame([("a", "Wheat", 0, 0), ("b", " wheat", 0, 1), ("a", "Wheat", 0, 2), ("c", None, 0, 3)], ROWS)
    assert [(r.iri, r["first"]) for r in dedup.label_collisions(df).collect()] == [("b", "a")]


def test_policies(spark):
    df, old = spark.createDataFrame([("a", "x", 1, 0), ("b", "y", 1, 1), (None, "z", 1, 2)], ROWS), spark.createDataFrame([("a",), (None,)], "iri string")
    assert sorted(r.iri or "" for r in dedup.against(df, old, "skip").collect()) == ["", "b"]
    assert dedup.against(df, old, "overwrite").count() == 3
    with pytest.raises(DedupError, match="a"):
        dedup.against(df, old, "error")
    with pytest.raises(DedupError, match="merge"):
        dedup.against(df.limit(0), old, "merge")
    assert dedup.against(df, old.limit(0), "error").count() == 3


def test_existing_collisions(spark):
    df = spark.createDataFrame([("a", "Wheat", 0, 0)], ROWS)
    old = spark.createDataFrame([("z", "wheat "), ("y", "WHEAT"), ("a", "rye")], "iri string, pref_label string")
    assert [(r.iri, r.existing) for r in dedup.existing_collisions(df, old).collect()] == [("a", "y")]


def test_ordered(spark):
    df = spark.createDataFrame([("m", "b", 2), ("m", "a", 1), ("n", "c", 3), ("m", "b", 4), ("n", "", 5)], "k string, v string, ord bigint")
    assert {(r.v, r.ord) for r in dedup.distinct_ordered(df, "v").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert {r["k"]: r["items"] for r in dedup.collect_ordered(df, ["k"], F.col("v")).collect()} == {"m": ["a", "b", "b"], "n": ["c", ""]}


def test_resolve(spark):
    index = resolve.last_wins(spark.createDataFrame([("1", "u", 0), ("1", "v", 1), (None, "w", 2)], "k string, x string, ord bigint"), "k", F.col("x"), "ord")
    got = [(r.ref, r.out) for r in resolve.resolve(spark.createDataFrame([("1",), ("2",), (None,)], "ref string"), "ref", index, "out").collect()]
    assert sorted(got, key=str) == [("1", "v"), ("2", "2"), (None, None)]


def test_checks(spark):
    df = spark.createDataFrame([("a", "x", 1, 0), ("a", None, None, 1), ("b", "y", 3, 2)], ROWS)
    parents = spark.createDataFrame([("a",), (None,)], "k string")
    report = checks.report(checks.unique(df, "iri", "u"), checks.row_count(df, 3, "c"), checks.not_null(df, ["pref_label", "ord"]), checks.in_domain(df, "pref_label", ["x"], "d"), checks.refers(df, F.col("iri"), parents, "k", "r"))
    assert {r.check: (r.ok, r.detail) for r in report.collect()} == {"u": (False, "1"), "c": (True, "3"), "not null: pref_label": (False, "1"), "not null: ord": (True, "0"), "d": (False, "1"), "r": (False, "1")}
    known = spark.createDataFrame([("chem x",), ("Europe without Switzerland, y",)], "k string")
    names = spark.createDataFrame([("US-chem x",), ("RER without CH, y",), ("lost",), (None,)], "n string")
    n = F.col("n")
    left = checks.uncovered(names, "n", known, "k", [n, F.regexp_replace(n, "^US-", ""), F.replace(n, F.lit("RER without CH"), F.lit("Europe without Switzerland"))])
    assert [r.n for r in left.collect()] == ["lost"]


@pytest.mark.parametrize("n, k", [(10, 3), (1, 4), (0, 2), (100, 7)])
def test_shards_are_slices_of_equal_length(spark, n, k):
    df = spark.createDataFrame([(i,) for i in range(n)], "i int")
    got = {r.i: r.shard for r in shard.shards(df, [F.col("i")], k).collect()}
    size = -(-n // k) or 1
    assert got == {i: i // size + 1 for i in range(n)}


def test_infer(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": null, "c": [1]}'), (2, '{"a": 1.5, "d": "x"}'), (3, None), (4, '{"a": true}')], "o bigint, j string")
    kinds = infer.json_kinds(df, "j", "o")
    assert {r["name"]: r.kind for r in kinds.collect()} == {"a": "double", "b": "string", "c": "list", "d": "string"}
    assert infer.schema(kinds).simpleString() == "struct<a:double,b:string,c:array<string>,d:string>"
    assert infer.record_schema([{"x": 1}, {"x": 1.5, "y": ["a"]}, {"z": None}]).simpleString() == "struct<x:double,y:array<string>,z:string>"


CROSS = "source_name string, source_category string, source_subcategory string, source_unit string, target_code string, target_name string, target_unit string, target_categories array<string>, unit_conversion double, tier string, target_db string"


def test_crosswalk_entries(spark):
    rows = [
        ("CO2", "air", "nan", "kg", "c1", "carbon dioxide", "kg", ["E", " "], 1.0, "T1", "ef"),
        ("CO2", None, None, "None", "c1", "nan", None, [" "], 2.5, "T3", "ef"),
        ("X", "air", "", "kg", "<NA>", "y", "kg", None, None, None, "ef"),
        ("X", "air", "", "kg", "c2", "y", "kg", None, None, None, "other"),
        (None, "air", "", "kg", "c2", "y", "kg", [], None, None, "ef"),
    ]
    a, b = assemble.crosswalk_entries(spark.createDataFrame(rows, CROSS), notes={"T3": "wider"}).collect()
    assert (a.source.context, a.target.context, a.conversion_factor, a.comment) == (["air"], ["E"], None, None)
    assert (b.source.unit, b.source.context, b.target.name, b.target.context, b.conversion_factor, b.comment) == (None, None, None, [], 2.5, "wider")


def test_curated_entries(spark):
    schema = "source_name string, source_unit string, source_context array<string>, source_cas string, target_db string, target_code string, target_name string, target_unit string, unit_conversion double, priority_tier bigint, provenance string"
    rows = [(" n ", "kg", ["a", ""], "1", "ef", "c", "t", "", 1.0, 2, "hand"), ("n", "kg", None, "", "ef", "", "t", "kg", 2.0, None, None), ("n", "kg", None, "", "ef", "", "t", "kg", 2.0, 1, "from barred"), ("n", "kg", None, "", "zz", "", "t", "kg", 2.0, 1, "hand"), ("n", "kg", None, "", "ef", "", " ", "kg", 2.0, 1, "hand"), ("n", "kg", None, "", "ef", "", "t", "kg", 2.0, 1, "bulk")]
    a, b = assemble.curated_entries(spark.createDataFrame(rows, schema), ["ef"], "barred", ["bulk"]).collect()
    assert a.source.asDict() == {"name": "n", "unit": "kg", "context": ["a"], "cas_number": "1"} and a.comment == "hand (priority tier 2)" and a.conversion_factor is None
    assert b.source.cas_number is None and b.target.code is None and b.comment == " (priority tier None)" and b.conversion_factor == 2.0
