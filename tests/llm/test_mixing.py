import random

from quernstone.llm import mixing as mx

D = "doc_id bigint, source string, lang string, n_tokens int"
T = "mix_id string, source string, target_share double, max_repeats int"


def docs(n=3000, seed=1):
    r = random.Random(seed)
    return [(i, "big" if r.random() < 0.6 else r.choice(["mid", "mid", "small", None]) if r.random() < 0.95 else "tiny", r.choice(["en", "EN ", "de", None]), r.randrange(20, 300)) for i in range(n)]


TARGETS = [("a", "big", 0.5, 1), ("a", "mid", 0.3, 2), ("a", "small", 0.1, 3), ("a", "tiny", 0.1, 8), ("b", "mid", 0.5, 1), ("b", "small", 0.5, 2), ("c", "nowhere", 0.5, 1), ("c", "big", 0.5, 1)]


def test_shares_are_reached_and_repeats_kept(spark):
    df, t = spark.createDataFrame(docs(), D).selectExpr("*", "1 AS h", "2 AS bucket", "3 AS rest"), spark.createDataFrame(TARGETS, T)
    sel = mx.mixed(df, t, bucket_docs=40)
    rows = sel.collect()
    assert len({(r.mix_id, r.doc_id) for r in rows}) == len(rows)
    limit = {(m, s): k for m, s, _, k in TARGETS}
    assert all(1 <= r.n_used <= limit[r.mix_id, r.source] for r in rows)
    for r in mx.shares(sel, t).collect():
        want = 1.0 if (r.mix_id, r.source) == ("c", "big") else 0.0 if r.source == "nowhere" else r.target_share
        assert abs(r.actual_share - want) < 0.004, r
    assert {(r.mix_id, r.doc_id, r.n_used) for r in mx.mixed(df.repartition(7), t, bucket_docs=40).collect()} == {(r.mix_id, r.doc_id, r.n_used) for r in rows}
    assert {(r.mix_id, r.doc_id) for r in mx.mixed(df, t, seed=3).collect()} != {(r.mix_id, r.doc_id) for r in rows}


def test_shortage_goes_to_siblings_before_ancestors():
    a = mx.Node(("a",), 0.5, children=[mx.Node(("a", "x"), 1.0, 10), mx.Node(("a", "y"), 1.0, 100)])
    b = mx.Node(("b",), 0.5, children=[mx.Node(("b", "x"), 1.0, 500)])
    root = mx.Node((), 1.0, children=[a, b])
    mx.split(root, 120.0)
    assert [c.budget for c in a.children] == [10.0, 50.0] and b.budget == 60.0  # language x is short, y takes over
    mx.split(root, 400.0)
    assert a.budget == 110.0 and b.budget == 290.0  # the whole source is short
    mx.split(root, 10_000.0)
    assert root.budget == 610.0
    assert mx.reachable([a, b]) == 220.0


def test_total_beyond_reach_uses_up_the_small_sources(spark):
    df = spark.createDataFrame(docs(), D)
    t = spark.createDataFrame([("a", "big", 0.2, 5), ("a", "tiny", 0.8, 2)], T)
    rows = mx.mixed(df, t, total_tokens=400_000).collect()
    tiny = [r for r in rows if r.source == "tiny"]
    assert {r.n_used for r in tiny} == {2} and len(tiny) == sum(d[1] == "tiny" for d in docs())
    assert abs(sum(r.n_tokens * r.n_used for r in rows) - 400_000) < 300


def test_prefix_against_brute_force(spark):
    r = random.Random(8)
    data = [("m", "s", "l", i, r.randrange(1, 50), r.randrange(1000)) for i in range(200)]
    df = spark.createDataFrame([(*d, d[5] // 100, 900.0, 0, 1, 0.5) for d in data], "mix_id string, source string, lang string, doc_id bigint, n_tokens bigint, h bigint, bucket int, rest double, whole int, open int, u double")
    got = {x.doc_id for x in mx._prefix(df, ["mix_id", "source", "lang"]).where("first = 1").collect()}
    want, total = set(), 0
    for d in sorted(data, key=lambda d: (d[5], d[3])):
        total += d[4]
        if total > 900:
            break
        want.add(d[3])
    assert got == want


def test_gaps_are_filled_until_nothing_fits(spark):
    r = random.Random(3)
    sizes = [r.choice([3, 7, 7, 7, 400]) for _ in range(400)]
    df = spark.createDataFrame([("m", "s", "l", i, n, 0, 5_000.0, 1, r.random(), int(i < 10)) for i, n in enumerate(sizes)], "mix_id string, source string, lang string, doc_id bigint, n_tokens bigint, whole int, rest double, open int, u double, first int")
    picked = {x.doc_id for x in mx._filled(df, ["mix_id", "source", "lang"]).collect()}
    assert not picked & set(range(10))
    left = 5_000 - sum(sizes[:10]) - sum(sizes[i] for i in picked)
    free = [n for i, n in enumerate(sizes) if i >= 10 and i not in picked]
    assert left >= 0 and all(n > left for n in free)


def test_a_short_language_is_made_up_by_its_siblings_before_other_sources(spark):
    rows = [(i, "x" if i % 2 else "y", "fr" if i < 40 else "de" if i < 400 else "en", 100) for i in range(2000)]
    df, t = spark.createDataFrame(rows, D), spark.createDataFrame([("a", "x", 0.5, 2), ("a", "y", 0.5, 2)], T)
    sel = mx.mixed(df, t, total_tokens=60_000, languages={"en": 1.0, "de": 1.0, "fr": 1.0}).collect()
    used = {}
    for r in sel:
        used[r.source, r.lang] = used.get((r.source, r.lang), 0) + r.n_tokens * r.n_used
    # French has 20 documents a source, twice 2,000 tokens of the 10,000 it should give
    assert used["x", "fr"] == used["y", "fr"] == 4_000
    assert used["x", "en"] == used["x", "de"] == 13_000 and used["y", "en"] == used["y", "de"] == 13_000


def test_a_short_source_is_made_up_within_its_domain(spark):
    rows = [(i, "small" if i < 10 else ["near", "far"][i % 2], "en", 100) for i in range(2000)]
    df = spark.createDataFrame(rows, D)
    t = spark.createDataFrame([("a", "small", 0.3, 2), ("a", "near", 0.3, 1), ("a", "far", 0.4, 1)], T)
    used = {}
    for r in mx.mixed(df, t, total_tokens=50_000, domains={"small": "one", "near": "one", "far": "two"}).collect():
        used[r.source] = used.get(r.source, 0) + r.n_tokens * r.n_used
    assert used == {"small": 2_000, "near": 28_000, "far": 20_000}


def test_levels_in_another_order(spark):
    rows = [(i, ["x", "y"][i % 2], "de" if i < 1000 else "en", 100) for i in range(3000)]
    df, t = spark.createDataFrame(rows, D), spark.createDataFrame([("a", "x", 0.25, 1), ("a", "y", 0.75, 1)], T)
    used = {}
    for r in mx.mixed(df, t, total_tokens=40_000, languages={"en": 0.5, "de": 0.5}, levels=("domain", "lang", "source"), domains={"x": "d", "y": "d"}).collect():
        used[r.source, r.lang] = used.get((r.source, r.lang), 0) + r.n_tokens * r.n_used
    assert used == {("x", "de"): 5_000, ("x", "en"): 5_000, ("y", "de"): 15_000, ("y", "en"): 15_000}


def test_empty_tables_and_nulls(spark):
    df, t = spark.createDataFrame(docs(50), D), spark.createDataFrame(TARGETS, T)
    assert mx.mixed(df.limit(0), t).count() == 0
    assert mx.mixed(df, t.limit(0)).count() == 0
    odd = spark.createDataFrame([("a", "big", None, None), ("a", "mid", -1.0, 2), (None, "big", 0.5, 1), ("a", None, 0.5, 1)], T)
    assert mx.mixed(df, odd).count() == 0


def test_the_selection_of_full_size_is_a_query(spark, tmp_path):
    from quernstone.llm import queries

    rows = [(i, "small" if i < 3 else "big", "en", f"Wheat flour of type {i}, stored at the mill") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("a", "big", 0.5, 3), ("a", "small", 0.5, 2)], T).write.parquet(f"{tmp_path}/mix_targets.parquet")
    used = lambda q: {(r.source, r.doc_id): r.n_used for r in queries.QUERIES[q](spark, str(tmp_path)).collect()}
    full, reached = used("p8_mixed_full"), used("p8_mixed")
    assert {k for (s, _), k in full.items() if s == "small"} == {2}  # used up, the other source makes up for it
    assert sum(full.values()) > 50 > sum(reached.values())
