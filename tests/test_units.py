import math
import random

import pytest
from pyspark.sql import functions as F

from quernstone.functions import spelling as sp
from quernstone.operators import units as un

UNITS = [("kg", "kilogram", "mass", "kg", 1.0), ("g", "gram", "mass", "kg", 1e-3), ("t", "tonne", "mass", "kg", 1e3), ("lb", "pound", "mass", "kg", 0.45359237), ("mg", "milligram", "mass", "kg", 1e-6), ("MJ", "megajoule", "energy", "MJ", 1.0), ("kWh", "kilowatt hour", "energy", "MJ", 3.6), ("m3", "cubic metre", "volume", "m3", 1.0)]


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame(UNITS, "unit_code string, unit_name string, quantity string, common_unit string, factor double")


@pytest.mark.parametrize("text, mult, base", [("10^3 kg", 1e3, "kg"), ("1'000 l", 1e3, "l"), ("1E3 kg", 1e3, "kg"), ("1e-3 m3", 1e-3, "m3"), ("10³ t.km", 1e3, "t.km"), ("Mio. kWh", 1e6, "kWh"), ("thousand kg", 1e3, "kg"), ("100 Bq", 100.0, "Bq"), ("kg", 1.0, "kg"), ("m┬│", 1.0, "m³")])
def test_multipliers(text, mult, base):
    assert sp.split_multiplier(text) == (mult, base)


@pytest.mark.parametrize("word, code", [("Kilogramm", "kg"), ("KGs", "kg"), ("Mg", "t"), ("mg.", "mg"), ("cbm", "m3"), ("m^3", "m3"), ("m³", "m3"), ("kW h", "kWh"), ("Kilowattstunde", "kWh"), ("m?", None), ("zork", None)])
def test_words(word, code):
    words = sp.lexicon([(c, n) for c, n, *_ in UNITS])
    assert (sp.suggested(word, words, {u[0] for u in UNITS}) or [None])[0] == code


def test_unknown_spellings_are_found_by_their_scale(spark, units):
    r = random.Random(3)
    rows = []
    for f in range(400):
        level = r.gauss(0, 1)
        for unit, factor in (("kg", 1.0), ("zentner", 1e3), ("zork", 1e-3), ("grams", 1e-3)):
            for _ in range(3):
                rows.append((f"f{f}", unit, 10 ** (level + r.gauss(0, 1)) / factor))
    amounts = spark.createDataFrame(rows, "entity string, spelling string, amount double")
    links = un.links_by_entity(amounts, [u[0] for u in UNITS])
    got = {x.spelling: (x.unit_code, x.how) for x in un.vocabulary(amounts.select("spelling"), links, units).collect()}
    assert got == {"kg": ("kg", "code"), "zentner": ("t", "scale"), "zork": ("g", "scale"), "grams": ("g", "both")}


def test_scales_travel_through_the_graph(spark, units):
    pairs = spark.createDataFrame([("aa", "kg", 1e-3)] * 9 + [("bb", "aa", 1e6)] * 9 + [("aa", "kg", 5.0)] * 2, "a string, b string, factor double")
    spell = spark.createDataFrame([("aa",), ("bb",), ("kg",), (None,), ("kg",)], "spelling string")
    got = {x.spelling: x.unit_code for x in un.vocabulary(spell, un.links_by_factor(pairs), units).collect()}
    assert got == {"aa": "g", "bb": "t", "kg": "kg"}


def test_scales_travel_as_far_as_links_go(spark, units):
    names = ["kg", *(f"x{i}" for i in range(1, 8))]
    pairs = spark.createDataFrame([(b, a, 1e-3 if i % 2 == 0 else 1e3) for i, (a, b) in enumerate(zip(names, names[1:], strict=False)) for _ in range(9)], "a string, b string, factor double")
    got = {x.spelling: x.unit_code for x in un.vocabulary(spark.createDataFrame([(n,) for n in names], "spelling string"), un.links_by_factor(pairs), units).collect()}
    assert got == {n: "kg" if i % 2 == 0 else "g" for i, n in enumerate(names)}


def test_amounts_and_factors(spark, units):
    vocab = spark.createDataFrame([("kg", 1.0, "kg", "code"), ("Tonne", 1.0, "t", "words"), ("10 g", 10.0, "g", "words"), ("MJ", 1.0, "MJ", "code"), ("?", 1.0, None, None)], "spelling string, multiplier double, unit_code string, how string")
    amounts = spark.createDataFrame([("e", 1, 2.0, "kg", "kg"), ("e", 2, 2.0, "Tonne", "Tonne"), ("e", 3, -1.0, None, "10 g"), ("e", 4, None, "Tonne", "Tonne"), ("e", 5, 0.0, None, "kg"), ("e", 6, 1.0, "?", "?"), ("e", 2, 2.0, "Tonne", "Tonne")], "tab string, rec_id bigint, amount double, unit string, spelling string")
    out = un.scientific(un.common_amounts(amounts, vocab, units), "value", "tab string, rec_id bigint, unit string, value string")
    assert sorted((r.rec_id, r.unit, r.value) for r in out.collect()) == [(2, "kg", "2.0000e+03"), (2, "kg", "2.0000e+03"), (3, "kg", "-1.0000e-02"), (5, "kg", "0.0000e+00")]
    pairs = spark.createDataFrame([("c", 1, "Tonne", "kg", 1000.0), ("c", 2, "Tonne", "kg", 1011.0), ("c", 3, "Tonne", "kg", None), ("c", 4, "kg", "MJ", 1.0), ("c", 5, "10 g", "Tonne", 1.0), ("c", 6, "?", "kg", 1.0)], "tab string, rec_id bigint, a string, b string, factor double")
    got = sorted((r.rec_id, r.unit, round(r.value, 9)) for r in un.wrong_factors(pairs, vocab, units).collect())
    assert got == [(2, "kg", 1000.0), (3, "kg", 1000.0), (5, "t", 1e-5)]


def test_units_in_names(spark):
    names = ["A, in kg", "A [m3]", "A (kWh)", "A, per 10^3 kg", "A; unit: t", "A – amount in MJ", "Ore, 36 % in rock", "A", None, "A (Item(s))", "A; unit: Item(s)", "A [Item(s)]"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", un.in_name(F.col("n")).alias("u"))
    assert [r.u for r in df.orderBy("i").collect()] == ["kg", "m3", "kWh", "10^3 kg", "t", "MJ", None, None, None, *["Item(s)"] * 3]


def test_empty_tables(spark, units):
    none = spark.createDataFrame([], "entity string, spelling string, amount double")
    vocab = un.vocabulary(none.select("spelling"), un.links_by_entity(none, ["kg"]), units)
    assert vocab.count() == 0
    assert math.isclose(un.fixed(units)["factor"].max(), 1e3)


def test_scale_and_offset_are_estimated_and_snapped(spark):
    rows = [("K", "kelvin", "temperature", "K", 1.0, 0.0), ("degC", "degree celsius", "temperature", "K", 1.0, 273.15), ("degF", "degree fahrenheit", "temperature", "K", 5 / 9, 255.3722222), ("kg", "kilogram", "mass", "kg", 1.0, None), ("g", "gram", "mass", "kg", 1e-3, None)]
    table = spark.createDataFrame(rows, "unit_code string, unit_name string, quantity string, common_unit string, factor double, offset double")
    r = random.Random(6)
    data = []
    for f in range(200):
        kelvin = r.uniform(240, 400)
        for unit, turn in (("K", lambda k: k), ("warmth", lambda k: k - 273.15), ("heat", lambda k: (k - 255.3722222) * 9 / 5), ("10 warmth", lambda k: (k - 273.15) / 10)):
            data += [(f"t{f}", unit, turn(kelvin + r.gauss(0, 0.5))) for _ in range(3)]
        mass = 10 ** r.gauss(0, 1)
        data += [(f"m{f}", unit, mass / by * 10 ** r.gauss(0, 0.3)) for unit, by in (("kg", 1.0), ("zork", 1e-3)) for _ in range(3)]
    amounts = spark.createDataFrame(data, "entity string, spelling string, amount double")
    links = un.links_by_entity(amounts, [u[0] for u in rows], offsets=True)
    vocab = un.vocabulary(amounts.select("spelling"), links, table)
    assert {x.spelling: x.unit_code for x in vocab.collect()} == {"K": "K", "warmth": "degC", "10 warmth": "degC", "heat": "degF", "kg": "kg", "zork": "g"}
    one = spark.createDataFrame([("e", 1, 20.0, None, "warmth"), ("e", 2, -3.0, None, "10 warmth"), ("e", 3, 5.0, None, "zork")], "tab string, rec_id bigint, amount double, unit string, spelling string")
    assert {x.rec_id: round(x.value, 6) for x in un.common_amounts(one, vocab, table).collect()} == {1: 293.15, 2: 243.15, 3: 0.005}
    pairs = spark.createDataFrame([("c", 1, "warmth", "heat", 1.0)], "tab string, rec_id bigint, a string, b string, factor double")
    assert un.wrong_factors(pairs, vocab, table).count() == 0


def test_most_rows_are_told_without_the_words_of_half_the_spellings(spark, units):
    """What the links say decides: a spelling without words is told from the flows it shares."""
    r = random.Random(12)
    spellings = {"kg": "kg", "Kilogramm": "kg", "kgs": "kg", "g": "g", "grams": "g", "Gramm": "g", "t": "t", "Tonnen": "t", "metric tons": "t", "mg": "mg", "milligrams": "mg", "1000 kilos": "kg", "1E3 kilos": "kg", "10^6 kilos": "kg"}
    factor = {u[0]: u[4] for u in UNITS}
    data = []
    for f in range(300):
        level = r.gauss(0, 1)
        for name in r.sample(sorted(spellings), 6):
            by = factor[spellings[name]] * sp.split_multiplier(name)[0]
            data += [(f"f{f}", name, 10 ** (level + r.gauss(0, 0.5)) / by) for _ in range(2)]
    amounts = spark.createDataFrame(data, "entity string, spelling string, amount double")
    links = un.links_by_entity(amounts, [u[0] for u in UNITS])
    hidden = ["Kilogramm", "grams", "Tonnen", "milligrams", "kilos", "metric tons"]
    told = un.vocabulary(amounts.select("spelling"), links, units, lambda base, words, codes: [] if base in hidden else sp.suggested(base, words, codes))
    got = {x.spelling: (x.unit_code, x.how) for x in told.collect()}
    rows = {n: sum(d[1] == n for d in data) for n in spellings}
    right = [n for n, c in spellings.items() if got[n][0] == c]
    assert sum(rows[n] for n in right) >= 0.9 * len(data)
    assert all(got[n][0] in (spellings[n], None) for n in spellings)
    assert sum(got[n][1] == "scale" for n in spellings) >= 6
