import random
from datetime import datetime, timedelta

from quernstone.operators import references as rf

P = "to string, key string, rec_id bigint, loaded_at timestamp, deleted_at timestamp"
R = "tab string, rec_id bigint, field string, to string, ref string, loaded_at timestamp"


def norm(k):
    k = (k or "").strip().lower()
    return None if k in ("", "nan", "none", "<na>") else k


def brute(refs, parents):
    month = lambda t: t.year * 12 + t.month
    out = set()
    for tab, rec, field, to, ref, t in refs:
        k = norm(ref)
        if k is None:
            continue
        own = [p for p in parents if p[0] == to and norm(p[1]) == k]
        if not own:
            out.add((tab, rec, field, ref, "missing"))
        elif t is None:
            continue
        elif all(p[3] is not None and month(p[3]) > month(t) for p in own):
            out.add((tab, rec, field, ref, "late"))
        else:
            last = max((p for p in own if p[3] is None or month(p[3]) <= month(t)), key=lambda p: (p[3] or datetime(1, 1, 1), p[2]))
            if last[4] is not None and last[4] <= t:
                out.add((tab, rec, field, ref, "deleted"))
    return out


def test_against_brute_force_with_a_hot_key(spark):
    r = random.Random(5)
    day = lambda: datetime(2023, 1, 1) + timedelta(hours=r.randrange(24 * 400))
    parents = [(r.choice("ab"), r.choice(["k%d", " K%d", "k%d "]) % r.randrange(30), i, day() if r.random() > 0.05 else None, day() if r.random() < 0.3 else None) for i in range(80)]
    refs = [("x", i, "f", r.choice("ab"), "k1" if r.random() < 0.4 else r.choice(["k%d", "K%d ", "q%d"]) % r.randrange(40), day() if r.random() > 0.03 else None) for i in range(600)]
    refs += [("x", 900, "f", "a", None, day()), ("x", 901, "f", "a", " NaN ", day()), ("x", 902, "f", "a", "", day()), ("x", 903, "f", "a", "z" * 100_000, day())]
    got = rf.orphans(spark.createDataFrame(refs, R), spark.createDataFrame(parents, P), target=50)
    assert {(x.tab, x.rec_id, x.field, x.ref_key, x.kind) for x in got.collect()} == brute(refs, parents)


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    t = datetime(2023, 5, 1)
    refs = spark.createDataFrame([("x", 1, "f", "a", "k", t), ("x", 1, "f", "a", "k", t)], R).selectExpr("*", "1 AS h", "2 AS slot", "3 AS side", "4 AS many")
    none = spark.createDataFrame([], P)
    assert [r.kind for r in rf.orphans(refs, none).collect()] == ["missing", "missing"]
    assert rf.orphans(refs.limit(0), none).count() == 0


def test_report(spark):
    t = datetime(2023, 12, 1)
    misses = rf.orphans(spark.createDataFrame([("x", 1, "f", "a", "k", t), ("x", 2, "f", "a", "k", None)], R), spark.createDataFrame([], P))
    assert {(r.month, r.kind, r.n_refs) for r in rf.report(misses).collect()} == {("2023-12", "missing", 1), (None, "missing", 1)}


def laid_parents(monkeypatch, refs, parents, target):
    """Parent rows and partitions that reach the probe."""
    from pyspark.sql import functions as F

    seen, kind = [], type(refs)
    by_id = kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda df, n, c: seen.append((df, n)) or by_id(df, n, c))
    rf.orphans(refs, parents, target=target)
    df, n = seen[0]
    return df.where("side = 0").count(), n, [r["count"] for r in df.where("side = 1").groupBy(F.col("slot")).count().collect()]


def test_parents_are_copied_for_hot_keys_alone(spark, monkeypatch):
    t = datetime(2023, 5, 1)
    parents = spark.createDataFrame([("a", f"k{i}", i, t, None) for i in range(3000)], P)
    refs = spark.createDataFrame([("x", i, "f", "a", "k7" if i % 3 == 0 else f"k{i % 3000}", t) for i in range(9000)], R)
    copies, parts, load = laid_parents(monkeypatch, refs, parents, 100)
    hot = -(-3001 // 100)
    assert copies <= 3000 + hot and 90 + hot - 2 <= parts <= 90 + hot + 2
    assert max(load) < 250


def test_without_hot_keys_no_parent_is_copied(spark, monkeypatch):
    t = datetime(2023, 5, 1)
    parents = spark.createDataFrame([("a", f"k{i}", i, t, None) for i in range(500)], P)
    refs = spark.createDataFrame([("x", i, "f", "a", f"k{i % 500}", t) for i in range(2000)], R)
    assert laid_parents(monkeypatch, refs, parents, 40)[0] == 500
