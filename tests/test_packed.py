import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernstone.operators.packed import facets, note, separated, unpack

texts = lambda vs: [v.text for v in vs]


@pytest.mark.parametrize(
    "packed, values",
    [
        ("A1#F01.Q1$F02.Q2", ["F01.Q1", "F02.Q2"]),
        ("A1 # F01.Q1 $ F02.Q2$", ["F01.Q1", "F02.Q2"]),
        ('"F01.a; b"|F02.Q2', ["F01.a; b", "F02.Q2"]),
        ('F01.so-called ""soft"" x', ['F01.so-called ""soft"" x']),
        ('"F01.so-called ""soft"" x",F02.b', ['F01.so-called "soft" x', "F02.b"]),
        ('"F01.a \\"b\\" c";F02.d', ['F01.a "b" c', "F02.d"]),
        ("'F01.baker''s'|'F02.b'", ["F01.baker's", "F02.b"]),
        ("F01.baker's choice,F02.b", ["F01.baker's choice", "F02.b"]),
        ('["F01.a", "F02.b"]', ["F01.a", "F02.b"]),
        ("F01.a;;F02.b;;", ["F01.a", "F02.b"]),
        ("F01.a / F02.b", ["F01.a", "F02.b"]),
        ("F01.1 / 2 fat$F02.b", ["F01.1 / 2 fat", "F02.b"]),
        ("", []),
        (None, []),
        ("A1#", []),
        (" | ; ", []),
    ],
)
def test_facets(packed, values):
    assert texts(facets(packed)) == values


def test_unclosed_quote_is_read_again_as_bare_and_flagged():
    got = facets('"F01.a$F02.b')
    assert texts(got) == ["F01.a", "F02.b"] and got[0].flag == "quote" and got[1].flag is None


words = st.text(st.sampled_from('ab c$|;,/"'), min_size=1, max_size=8).map(str.strip).filter(bool)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, min_size=1, max_size=6))
def test_round_trip_of_quoted_values(values):
    full = [f"F{i:02d}.{v}" for i, v in enumerate(values, 1)]
    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_ALL, delimiter="$", lineterminator="").writerow(full)
    assert texts(facets("Q1#" + buf.getvalue())) == full


@pytest.mark.parametrize(
    "packed, values",
    [
        ("Covers a | b. Near £3 per kg.£https://x.example/a/1£doc:FX-1", ["Covers a | b. Near £3 per kg.", "https://x.example/a/1", "doc:FX-1"]),
        ('"Says ""raw"" here." ; https://x.example/1', ['Says "raw" here.', "https://x.example/1"]),
        ("A note.\n\nhttp://a.b/1\n\ndoc:XX-0000", ["A note.", "http://a.b/1", "doc:XX-0000"]),
        ("https://x.example/1|https://x.example/2", ["https://x.example/1", "https://x.example/2"]),
        ("Only a note; with marks £ and | in it.", ["Only a note; with marks £ and | in it."]),
        ("NoteÂ£http://a.b/1", ["Note", "http://a.b/1"]),
        ("", []),
        (None, []),
    ],
)
def test_notes(packed, values):
    assert texts(note(packed)) == values


def test_unpack_counts_through_the_array(spark):
    rows = [(1, "f", ["A#F01.a$F02.b", None, "", "F03.c"]), (2, "f", None), (3, "f", []), (4, "f", ["F01.x"]), (1, "f", ["F01.a|F02.b"]), (5, "f", ["$".join(f"F01.v{i}" for i in range(5000))])]
    df = spark.createDataFrame(rows, "rec_id bigint, field string, packed array<string>").selectExpr("*", "'z' AS value", "7 AS pos")
    got = [(r.rec_id, r.pos, r.value) for r in unpack(df, "facets", least=2).where("rec_id < 5").collect()]
    assert got == [(1, 1, "F01.a"), (1, 2, "F02.b"), (1, 3, "F03.c"), (1, 1, "F01.a"), (1, 2, "F02.b")]
    assert unpack(df, "facets").where("rec_id = 5").count() == 5000
    assert unpack(df.limit(0), "facets").count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("F17.dried [whole]$F20.x", ["F17.dried [whole]", "F20.x"]),
        ("[F17.dried [whole], F20.cut [in [two]]]", ["F17.dried [whole]", "F20.cut [in [two]]"]),
        ("[F17.a, F20.b]$[F21.c]", ["F17.a", "F20.b", "F21.c"]),
        ("F17.open [whole$F20.x", ["F17.open [whole", "F20.x"]),
    ],
)
def test_brackets_of_a_value_stay_with_it(text, want):
    assert texts(facets(text)) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a;b;c", ["a", "b", "c"]),
        ("(F01.a; F02.b)|F03.c", ["F01.a", "F02.b", "F03.c"]),
        ("X#F01.a [x; F02.b] y$F03.c", ["F01.a [x; F02.b] y", "F03.c"]),
        ("F01.a (cut; sliced)$F02.b", ["F01.a (cut; sliced)", "F02.b"]),
        ("[[F01.a]; [F02.b]]", ["F01.a", "F02.b"]),
    ],
)
def test_brackets_and_values_of_any_form(text, want):
    assert texts(facets(text)) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("red; \"green; dark\" | blue", ["red", "green; dark", "blue"]),
        ("(red; green) | blue", ["red", "green", "blue"]),
        ("2 (two; 2) ; [2,4-D] acid", ["2 (two; 2)", "[2,4-D] acid"]),
        ("rock'n'roll, it''s", ["rock'n'roll", "it''s"]),
        ("only one", ["only one"]),
        (")a(; b]", [")a(", "b]"]),
        (None, []),
        (";;|", []),
    ],
)
def test_free_values(text, want):
    assert texts(separated(text)) == want


def test_unclosed_brackets_are_flagged():
    got = facets("[F01.a, F02.b")
    assert texts(got) == ["F01.a", "F02.b"] and got[0].flag == "bracket" and got[1].flag is None


@pytest.mark.parametrize("make", [
    lambda n: (note, "A note; " + "; ".join(f"http://a.b/{i}" for i in range(n))),
    lambda n: (facets, "F01.a" + ";" * n + "x"),
    lambda n: (facets, "F01.a" + "[" * n + "$F02.b"),
    lambda n: (facets, "[" * n + "F01.a" + "]" * n),
    lambda n: (facets, "$".join(f"F01.v {i}" for i in range(n))),
    lambda n: (note, "a" + " ;" * n + "b"),
])
def test_long_texts_take_linear_time(make):
    import time

    def took(n):
        f, text = make(n)
        best = 9.0
        for _ in range(3):
            began = time.perf_counter()
            f(text)
            best = min(best, time.perf_counter() - began)
        return best

    assert took(32_000) < 12 * max(took(8_000), 0.002)  # sixteen times if quadratic
