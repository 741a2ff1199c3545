import pytest

from quernstone.errors import ValidationError
from quernstone.validate import schema as vs

BASE = """
classes:
  Named:
    attributes:
      iri: {identifier: true, required: true, range: uriorcurie}
      pref_label: {required: true}
"""
MAIN = """
imports: [linkml:types, base]
enums:
  status_enum: {permissible_values: {draft: , published: }}
classes:
  ThingCollection:
    tree_root: true
    attributes:
      scheme: {required: true, range: uriorcurie}
      things: {multivalued: true, range: Thing}
  Thing:
    is_a: Named
    attributes:
      alt_labels: {multivalued: true}
      related: {multivalued: true, range: uriorcurie}
      status: {range: status_enum}
"""


@pytest.fixture
def path(tmp_path):
    (tmp_path / "base.yaml").write_text(BASE)
    (tmp_path / "thing.yaml").write_text(MAIN)
    return tmp_path / "thing.yaml"


GOOD = "ord bigint, iri string, pref_label string, alt_labels array<string>, related array<string>, status string"


def test_rows(spark, path):
    ok = spark.createDataFrame([(0, "x:a", "A", ["b"], ["x:c"], "draft"), (1, "x:b", "B", None, None, None)], GOOD)
    vs.validate(ok, "schema", path=path, cls="Thing")
    bad = spark.createDataFrame([(0, "x:a", None, None, None, "odd"), (1, "x:a", "B", None, ["no uri"], None), (2, None, "C", None, None, None)], GOOD)
    got = [(r.row, r.problem.split(" ")[0:2]) for r in vs.problems(bad, vs.load(path), "Thing").orderBy("row", "problem").collect()]
    assert [(r, w[1]) for r, w in got] == [(0, "'iri'"), (0, "'pref_label'"), (0, "'status'"), (1, "'related'"), (2, "'iri'")]
    with pytest.raises(ValidationError, match="row 0"):
        vs.validate(bad, "schema", path=path, cls="Thing")


def test_closed_slots_kinds_and_missing_columns(spark, path):
    df = spark.createDataFrame([(0, "x:a", "zz", "one")], "ord bigint, iri string, extra string, alt_labels string")
    got = sorted(r.problem for r in vs.problems(df, vs.load(path), "Thing").collect())
    assert got == ["slot 'alt_labels' should be a list", "slot 'extra' is not allowed", "slot 'pref_label' is required"]


def test_collection(spark, path):
    df = spark.createDataFrame([(0, "x:a", "A", None, None, None)], GOOD)
    vs.validate(df, "collection", {"scheme": "x:s"}, path, "ThingCollection")
    with pytest.raises(ValidationError, match="scheme"):
        vs.validate(df, "collection", {}, path, "ThingCollection")
    with pytest.raises(ValidationError, match="other"):
        vs.validate(df, "collection", {"scheme": "x:s", "other": 1}, path, "ThingCollection")


def test_package_none_unknown_and_missing_inputs(spark, path):
    df = spark.createDataFrame([(("n",),), ((None,),)], "source struct<name:string>")
    with pytest.raises(ValidationError, match="no property"):
        vs.validate(df, "package", {"name": "p", "version": "1"})
    with pytest.raises(ValidationError, match="version"):
        vs.validate(df, "package", {"name": "p"})
    vs.validate(df, "none")
    for call in (lambda: vs.validate(df, "odd"), lambda: vs.validate(df, "schema"), lambda: vs.load(path.parent / "no.yaml"), lambda: vs.slots(vs.load(path), "Nope")):
        with pytest.raises(ValidationError):
            call()
    assert vs.struct(vs.load(path), "Thing").simpleString() == "struct<iri:string,pref_label:string,alt_labels:array<string>,related:array<string>,status:string>"
