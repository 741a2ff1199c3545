import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quernstone.functions import arrays, ids, keys, routing, text
from quernstone.functions.uncertainty import uncertainty


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", list: "array<string>", type(None): "string", datetime: "timestamp", bool: "boolean"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("r")).first()["r"]


A, B, C = F.col("a"), F.col("b"), F.col("c")


@pytest.mark.parametrize("raw, want", [(" AbC ", "abc"), ("NaN", None), (" <NA>\t", None), ("", None), (None, None), ("none x", "none x")])
def test_key(spark, raw, want):
    assert one(spark, keys.key(A), a=raw) == want


@pytest.mark.parametrize("s", ["alpha widget", "foo-bar it's", "  x1y  ", "ALREADY Big"])
def test_title(spark, s):
    assert one(spark, text.title(A), a=s) == s.strip().title() == one(spark, text.title_any(A), a=s)


@pytest.mark.parametrize("s, slug", [("viandes, œufs, poissons", "viandes-ufs-poissons"), ("½ cup", "12-cup"), ("ﬁne Crème", "fine-creme"), ("--", "")])
def test_slug(spark, s, slug):
    assert one(spark, text.slugify_any(A), a=s) == slug


def test_text(spark):
    assert one(spark, text.compartment_slug(A), a="Emissions to Air!") == "emissions-to-air"
    assert one(spark, text.squash(A), a=" a   b\n") == "a b"
    assert one(spark, text.squash(A), a=None) == ""
    for word in ("Straße", "STRASSE", "ΟΔΟΣ", "ﬁn", "ŉ ſ µ", "İstanbul", "ᾳ ᾼ", "plain Ä"):
        assert one(spark, text.folded(A), a=word) == word.casefold()
    assert one(spark, text.strip_html(A), a="<b>x</b>  <i>y</i>") == "x y"
    assert one(spark, text.before(A, "£"), a=" note £http") == "note"
    assert one(spark, text.before(A, "£"), a="£http") is None
    assert one(spark, text.definition(A, F.lit(True), length=3), a="abcdef") == "[obsolete] abc"
    assert one(spark, text.definition(A), a="  ") is None
    assert one(spark, text.comment(A, B, F.lit(True), "old", "cite"), a="x", b="y") == "Category: x / y. old. Source: cite"
    assert one(spark, text.path(A, B, C), a=" x ", b="", c="z") == "x / z"
    assert one(spark, text.denulled(A), a=" NaN ") == ""
    assert one(spark, text.repaired(A), a="CrÃ¨me") == "Crème"
    assert one(spark, text.iso(A), a=datetime(2026, 6, 5, 12, 30, 0, 5)) == "2026-06-05T12:30:00.000005"
    assert one(spark, text.nonblank(A), a=" ") is False


def test_ids(spark):
    for name, cat, sub in [("CO2", "air", "urban"), ("é", None, ""), ("", "", "")]:
        want = str(uuid.uuid5(uuid.UUID(ids.FLOW_NAMESPACE), f"{name}|{cat or ''}|{sub or ''}"))
        assert one(spark, ids.flow_id(A, B, C), a=name, b=cat, c=sub) == want
    assert one(spark, ids.iri("products", A), a="7") == "https://vocab.example/products/7"
    assert one(spark, ids.code_or_slug_iri(F.lit(None).cast("string"), A, "p"), a="Crème X") == "https://vocab.example/p/creme-x"
    assert one(spark, ids.method_id(A, "ef"), a="Land use") == "ef:land-use"


def test_arrays(spark):
    assert one(spark, arrays.dedupe(A), a=["A", "a", "", None, "b", "B"]) == ["A", "b"]
    assert one(spark, arrays.alt_labels(B, A), a=["x", "Tef", "X"], b="tef") == ["x"]
    assert one(spark, arrays.alt_labels(B, A), a=["Tef"], b="tef") is None
    assert one(spark, arrays.facet_codes(A), a="own#F01.X$F02.Y.Z$bad$F03. W ") == ["X", "Y.Z", "W"]
    assert one(spark, arrays.facet_codes(A), a="F01.X") == ["X"]
    assert one(spark, arrays.prefixed(A, "ec"), a=["1", "2"]) == ["ec:1", "ec:2"]
    assert one(spark, arrays.first_element(A), a=[]) is None


def test_routing(spark):
    assert one(spark, routing.term_category(A), a=["n", "f"]) == "organisms"
    assert one(spark, routing.term_category(A), a=["?"]) == "products"
    assert one(spark, routing.sector(A), a="heat") == "05-energy"
    assert one(spark, routing.sector_slug(A), a="10-building-services") == "building-services"
    with pytest.raises(Exception, match="not in the sector map"):
        one(spark, routing.sector(A), a="nothing")
    for iri, want in [("https://x/flow-contexts/envi-air-low/", "air"), ("https://x/flow-contexts/reso-grou", "natural resource"), ("https://x/flow-contexts/envi-zzz", None), ("https://x/other/envi-air", None), (None, None)]:
        assert one(spark, routing.context_compartment(A), a=iri) == want
    assert [one(spark, routing.flow_type(A, B), a=g, b=c) for g, c in [("output", 0), ("input", 4), ("output", 4), ("input", 5)]] == ["production", "biosphere", "biosphere", "technosphere"]
    assert one(spark, routing.flow_type(A, F.lit(None).cast("int")), a="output") == "technosphere"
    assert one(spark, routing.obsolete(A, B, C), a="xx y", b="", c="") is True
    assert one(spark, routing.status(A), a=" approved ") == "draft"
    assert one(spark, routing.real_factor(A), a=1.0) is None
    assert one(spark, routing.real_factor(A), a=float("nan")) != 1.0


@pytest.mark.parametrize("amount, kind, sd, want", [(2.0, "1", 1.21, (2, 0.693147, 0.09531)), (0.5, "2", 0.1, (3, 0.5, 0.05)), (1.0, "0", 1.2, (None,) * 3), (1.0, "1", None, (None,) * 3), (0.0, "1", 1.21, (None,) * 3)])
def test_uncertainty(spark, amount, kind, sd, want):
    df = spark.createDataFrame([(amount, kind, sd)], "a double, k string, s double")
    got = tuple(df.select(*(c.alias(n) for n, c in zip("xyz", uncertainty(F.col("a"), F.col("k"), F.col("s")), strict=True))).first())
    assert [None if v is None else round(v, 6) for v in got] == list(want)
