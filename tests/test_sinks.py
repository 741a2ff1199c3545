import json
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import yaml

from quernstone.errors import DeliveryError, EngineError
from quernstone.model import RunContext, target
from quernstone.sinks import writers as w

SCHEMA = "ord bigint, iri string, notation string, alt_labels array<string>"


@pytest.fixture
def payload(spark):
    df = spark.createDataFrame([(0, "x:b", "B", None), (1, "x:a", "A", ["é"]), (2, "x:0", None, None)], SCHEMA)
    return w.Payload(df, {"scheme": "x:s"}, "things")


def test_documents(payload, tmp_path):
    doc = json.loads(w.write(payload, tmp_path / "d/a.json", "json").read_text())
    assert list(doc) == ["scheme", "things"] and doc["things"][0] == {"iri": "x:b", "notation": "B"} and doc["things"][1]["alt_labels"] == ["é"]
    assert yaml.safe_load(w.write(payload, tmp_path / "a.yaml", "yaml").read_text()) == doc
    with pytest.raises(EngineError):
        w.write(payload, tmp_path / "a.odd", "odd")
    w.register("odd", lambda p, path: path.write_text("x"))
    assert w.write(payload, tmp_path / "a.odd", "odd").read_text() == "x"


def test_parquet_is_sorted_and_carries_the_scheme(payload, tmp_path):
    t = pq.read_table(w.write(payload, tmp_path / "a.parquet", "parquet"))
    assert t["iri"].to_pylist() == ["x:a", "x:b", "x:0"] and t.schema.metadata == {b"scheme": b"x:s"} and t["alt_labels"].to_pylist()[0] == ["é"]


def test_bulk(payload, spark, tmp_path):
    w.write(payload, tmp_path / "bulk.parquet", "parquet-dir")
    assert spark.read.parquet(str(tmp_path / "bulk.parquet")).count() == 3
    w.write(payload, tmp_path / "bulk.jsonl", "jsonl")
    assert spark.read.json(str(tmp_path / "bulk.jsonl")).count() == 3


def test_shards(tmp_path):
    import random

    r = random.Random(0)
    t = pa.table({"i": list(range(4000)), "s": [str(r.random()) for _ in range(4000)]}).replace_schema_metadata({"scheme": "s"})
    pq.write_table(t, tmp_path / "a.parquet")
    parts = w.shard_file(tmp_path / "a.parquet", 20_000)
    assert len(parts) > 2 and all(p.stat().st_size <= 20_000 for p in parts) and parts[0].name == "a-01.parquet"
    back = pa.concat_tables(pq.read_table(p) for p in parts)
    assert back["i"].to_pylist() == list(range(4000)) and back.schema.metadata == {b"scheme": b"s"}
    meta = json.loads(w.sector_metadata(tmp_path, "01-x", "X", "d").read_text())
    assert meta["row_counts"]["a.parquet"] == 4000 and (meta["sector"], meta["rank"]) == ("x", 1)


def test_deliver(tmp_path):
    f = tmp_path / "f.json"
    f.write_text("1")
    to, calls = target("vocab"), []

    def run(cmd, **kw):
        calls.append(cmd[:2])
        if cmd[1] == "clone":
            Path(cmd[-1]).mkdir()

    assert w.deliver([f], to, "x", RunContext(), tmp_path, run) is False and not calls
    assert w.deliver([f], to, "x", RunContext(dry_run=False), tmp_path, run) is True
    assert (tmp_path / "vocab/data/f.json").exists() and calls[-1] == ["gh", "pr"]

    def fail(cmd, **kw):
        raise OSError("no git")

    with pytest.raises(DeliveryError):
        w.deliver([f], to, "y", RunContext(dry_run=False), tmp_path, fail)
    with pytest.raises(DeliveryError):
        w.deliver_local([f], to, "c", tmp_path / "none")
