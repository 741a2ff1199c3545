from datetime import datetime

from quernstone.streaming import landing

SCHEMA = "iri string, pref_label string, loaded_at timestamp"


def put(spark, folder, rows, n):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def test_new_identifiers_are_appended_once(spark, tmp_path):
    t = datetime(2024, 1, 1)
    old = tmp_path / "old"
    spark.createDataFrame([("a", "A", t)], SCHEMA).write.parquet(str(old))
    into = lambda: landing.into(landing.landed(spark, str(tmp_path / "in"), SCHEMA), str(old), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    put(spark, tmp_path / "in", [("a", "A", t), ("b", "B", t), ("b", "B", t)], 1)
    into()
    put(spark, tmp_path / "in", [("b", "B2", t), ("c", "C", t)], 2)
    into()
    got = sorted((r.iri, r.pref_label) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("b", "B"), ("c", "C")]


def test_windows_and_watermarked_distinct(spark, tmp_path):
    rows = [("a", "A", datetime(2024, 1, 1, 0, 10)), ("a", "A", datetime(2024, 1, 1, 0, 20)), ("b", "B", datetime(2024, 1, 1, 2, 0))]
    put(spark, tmp_path / "in", rows, 1)
    stream = landing.landed(spark, str(tmp_path / "in"), SCHEMA)
    for name, df, mode in (("w", landing.arrivals(stream, "loaded_at", []), "complete"), ("f", landing.fresh(stream, "iri", "loaded_at"), "append")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.n for r in spark.table("w").collect()) == [1, 2]
    assert sorted(r.iri for r in spark.table("f").collect()) == ["a", "b"]
