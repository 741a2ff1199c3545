import gzip
import io
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from quernstone.errors import FetchError, ParseError, RegistryError, ValidationError
from quernstone.model import RunContext, SourceConfig
from quernstone.plans import pipeline, registry
from quernstone.sources import families, readers, turtle, xlsx
from quernstone.sources.fetch import fetch


def rows(df):
    return [r.asDict(True) for r in df.orderBy("ord").drop("ord").collect()]


def put(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_csv_json_yaml(spark, tmp_path):
    assert rows(readers.read(spark, put(tmp_path / "a.csv", 'id,name\n1,"a ""b"" "\n2,\n'), "csv")) == [{"id": "1", "name": 'a "b" '}, {"id": "2", "name": ""}]
    assert rows(readers.read(spark, put(tmp_path / "a.json", '[{"a": 1}, {"a": 2}]'), "json")) == [{"a": 1}, {"a": 2}]
    assert rows(readers.read(spark, put(tmp_path / "b.json", '{"a": 1}'), "json")) == [{"a": 1}]
    assert rows(readers.read(spark, put(tmp_path / "a.yaml", "- a: 1\n- a: 2\n  b: [x]\n"), "yaml")) == [{"a": 1, "b": None}, {"a": 2, "b": ["x"]}]
    for bad, f in (('"x"', "json"), ("x", "yaml")):
        with pytest.raises(ParseError):
            readers.read(spark, put(tmp_path / f"bad.{f}", bad), f)
    with pytest.raises(ParseError):
        readers.read(spark, "x", "odd")
    readers.register("odd", readers.csv)
    assert readers.read(spark, str(tmp_path / "a.csv"), "odd").count() == 2


TTL = """@prefix ex: <http://e.x/> . @prefix skos: <http://skos/> .
ex:a a skos:Concept ; skos:prefLabel "Crème \\"x\\""@fr, 'y'^^ex:t ; skos:broader ex:b ; ex:n 4.5 . # note
ex:b skos:member ( ex:a "z" ) ; ex:has [ ex:p true ] ."""


def test_turtle(spark, tmp_path):
    got = {tuple(t.values()) for t in turtle.triples(TTL)}
    assert ("http://e.x/a", turtle.RDF + "type", "http://skos/Concept") in got
    assert ("http://e.x/a", "http://skos/prefLabel", 'Crème "x"') in got and ("http://e.x/a", "http://e.x/n", "4.5") in got
    assert len([t for t in got if t[1].endswith(("first", "rest"))]) == 4 and ("_:b3", "http://e.x/p", "true") in got
    assert readers.read(spark, put(tmp_path / "a.ttl", TTL), "rdf").count() == len(got)
    for bad in ("<?xml version='1.0'?><rdf/>", "ex:a ex:b ex:c .", "@prefix ex: <x> . ex:a ex:b"):
        with pytest.raises(ParseError):
            list(turtle.triples(bad))


def book(sheet, shared=""):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{shared}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")
    return f.getvalue()


def test_xlsx(spark, tmp_path):
    text = lambda r, s: f'<c r="{r}" t="inlineStr"><is><t>{s}</t></is></c>'
    content = book(f'<row/><row>{text("A2", " code ")}{text("B2", "label")}{text("C2", "updated")}</row><row>{text("A3", "x")}<c r="B3" t="s"><v>0</v></c><c r="C3" s="1"><v>46178.520833333</v></c></row><row/><row><c r="A5"><v>7</v></c></row>', "<si><t>hé</t></si>")
    assert xlsx.records(content) == [{"code": "x", "label": "hé", "updated": "2026-06-05T12:30:00"}, {"code": 7}]
    assert rows(readers.read(spark, put(tmp_path / "a.xlsx", content), "xlsx"))[1] == {"code": "7", "label": None, "updated": None}
    for bad in (b"no zip", book(""), book(f'<row>{text("A1", "x")}{text("B1", "x")}</row>')):
        with pytest.raises(ParseError):
            xlsx.records(bad)


def test_fetch(tmp_path):
    ctx = RunContext(cache_dir=tmp_path / "c")
    src = tmp_path / "a.txt"
    src.write_text("1")
    url = src.as_uri()
    with pytest.raises(FetchError):
        fetch(url, RunContext(cache_dir=tmp_path / "c", offline=True))
    assert fetch(url, ctx).read_text() == "1"
    src.write_text("2")
    assert fetch(url, RunContext(cache_dir=tmp_path / "c", offline=True)).read_text() == "1"  # the cache is keyed by URL
    for bad in ("odd://x", (tmp_path / "no").as_uri()):
        with pytest.raises(FetchError):
            fetch(bad, ctx)


# --- food terms ------------------------------------------------------------------------------


def term(code, name, kind, parent="", note="", short="", status="APPROVED", attrs=()):
    every = [("termType", [kind]), *attrs]
    xml = "".join(f"<implicitAttribute><attributeCode>{k}</attributeCode><attributeValues>{''.join(f'<attributeValue>{v}</attributeValue>' for v in vs)}</attributeValues></implicitAttribute>" for k, vs in every)
    return f"<term><termDesc><termCode>{code}</termCode><termExtendedName>{name}</termExtendedName><termShortName>{short}</termShortName><termScopeNote>{note}</termScopeNote></termDesc><termVersion><status>{status}</status></termVersion><hierarchyAssignments><hierarchyAssignment><hierarchyCode>report</hierarchyCode><parentCode>ZZ</parentCode></hierarchyAssignment><hierarchyAssignment><hierarchyCode>MTX</hierarchyCode><parentCode>{parent}</parentCode></hierarchyAssignment></hierarchyAssignments><implicitAttributes>{xml}</implicitAttributes></term>"


def catalogue(path, *terms):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("MTX.XML", f"<message><catalogue><catalogueTerms>{''.join(terms)}</catalogueTerms></catalogue></message>")
    return path


def test_food(spark, tmp_path):
    f = catalogue(
        tmp_path / "m.ecf", term("FOOD", "Food", "g"), term("ORG1", "Eragrostis", "n"), term("FAC1", "Milled", "f"),
        term("A000A", " Teff grain ", "r", "FOOD", "Grain of teff.£http://x", "TEFF", attrs=[("A01", ["Eragrostis tef", "teff GRAIN"]), ("A02", ["Tef grain", "teff"]), ("allFacets", ["A000A#F01.ORG1$F27.A000A$F02.NOPE"]), ("implicitFacets", ["F03.FAC1$F01.ORG1"]), ("foodexOldCode", ["A.01"]), ("GEMSCode", ["GC 0652", " "])]),
        term("A001B", "Old", "d", "NOPE", status="DEPRECATED"), term("A999Z", " ", "r"),
    )
    config = SourceConfig("x", "Food", "vocab", "products", f.as_uri(), "ecf", "parquet")
    got = {r["notation"]: r for r in rows(families.source(config).transform(families.source(config).read(spark, RunContext(cache_dir=tmp_path / "c"))))}
    assert set(got) == {"FOOD", "A000A", "A001B"}
    a, iri = got["A000A"], "https://vocab.example"
    assert a["pref_label"] == "Teff grain" and a["definition"] == "Grain of teff." and a["status"] == "draft"
    assert a["alt_labels"] == ["TEFF", "Tef grain", "Eragrostis tef"]
    assert a["broader"] == f"{iri}/products/foodex2/FOOD" and a["related"] == [f"{iri}/organisms/foodex2/ORG1", f"{iri}/qualifiers/foodex2/FAC1"]
    assert a["additional_notations"] == ["foodex1:A.01", "gems:GC 0652"]
    assert got["A001B"]["broader"] is None and got["A001B"]["status"] == "deprecated" and got["FOOD"]["alt_labels"] is None


# --- inventory -------------------------------------------------------------------------------


def dataset(number, name, category="electricity", sub="x", exchanges="", comment=""):
    return f'<ecoSpold><dataset number="{number}"><metaInformation><processInformation><referenceFunction name="{name}" category="{category}" subCategory="{sub}" unit="kWh" generalComment="{comment}"/><geography location="CH"/></processInformation></metaInformation><flowData>{exchanges}</flowData></dataset></ecoSpold>'


EX = """<exchange number="101" name="Power" unit="kWh" meanValue="1.0" location="CH"><outputGroup>0</outputGroup></exchange>
<exchange number="0102" name=" Gas " unit="MJ" meanValue="2.0" uncertaintyType="1" standardDeviation95="1.21"><inputGroup> 5 </inputGroup></exchange>
<exchange number="999" name="Lost" unit="MJ"><inputGroup>5</inputGroup></exchange>
<exchange name="CO2" category="emissions to air" subCategory="" CASNumber="000124-38-9" unit="kg" meanValue="0.5" uncertaintyType="2" standardDeviation95="0.1"><outputGroup>4</outputGroup></exchange>"""


@pytest.fixture
def inventory(tmp_path):
    path = tmp_path / "e.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("process_aaaa.xml", dataset("101", "Power", exchanges=EX, comment="A  long\tcomment"))
        z.writestr("process_bbbb.xml", dataset("0102", "Gas", "natural gas", exchanges='<exchange name="CO2" category="emissions to air" subCategory="" unit="kg"><outputGroup>4</outputGroup></exchange>'))
        z.writestr("process_cccc.xml", dataset("103", "xx Old", "energy, obsolete", "notMaintained"))
        z.writestr("notes.txt", "x")
    return path


def lci(spark, tmp_path, path, family, **kw):
    c = SourceConfig("x", family, kw.pop("target", "inventory"), kw.pop("category", "02-electricity"), path.as_uri(), "zip", "parquet", **kw)
    s = families.source(c)
    return rows(s.transform(s.read(spark, RunContext(cache_dir=tmp_path / "c"))))


def test_inventory_exchanges(spark, tmp_path, inventory):
    got = lci(spark, tmp_path, inventory, "LciExchanges")
    assert [(r["flow_type"], r["flow_name"], r["direction"], r["amount"]) for r in got] == [("production", "Power", "output", 1.0), ("technosphere", " Gas ", "input", 2.0), ("technosphere", "Lost", "input", 0.0), ("biosphere", "CO2", "output", 0.5)]
    assert [got[0]["flow"], got[1]["flow"], got[2]["flow"]] == ["aaaa", "bbbb", "999"]
    assert (got[1]["uncertainty_type"], round(got[1]["loc"], 6), round(got[1]["scale"], 6)) == (2, 0.693147, 0.09531)
    assert (got[3]["uncertainty_type"], got[3]["loc"], got[3]["scale"], got[3]["minimum"]) == (3, 0.5, 0.05, None)
    terms = lci(spark, tmp_path, inventory, "LciFlowTerms", target="vocab", emit="emissions-to-air")
    assert [(t["notation"], t["cas_number"], t["sub_compartment"]) for t in terms] == [(got[3]["flow"], "000124-38-9", "")]


def test_inventory_processes(spark, tmp_path, inventory):
    (p,) = lci(spark, tmp_path, inventory, "LciProcesses")
    assert p["process_id"] == "aaaa" and p["reference_unit"] == "kWh" and p["reference_amount"] == 1.0 and p["location"] == "CH" and p["technology"] is None
    assert p["comment"].startswith("BAFU category: electricity / x. Source: ")
    every = lci(spark, tmp_path, inventory, "LciProcessTerms", target="vocab")
    assert [t["definition"] for t in every] == ["A long comment", None, "[obsolete]"]
    assert [t["notation"] for t in lci(spark, tmp_path, inventory, "LciProcessTerms", target="vocab", emit="obsolete")] == ["cccc"]


def test_unknown_category_and_bad_member(spark, tmp_path):
    for name, xml, message in (("process_a.xml", dataset("1", "n", "nothing"), "sector map"), ("odd.xml", dataset("1", "n"), "file name"), ("process_a.xml", "<ecoSpold/>", "no dataset|sector map")):
        with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
            z.writestr(name, xml)
        s = families.source(SourceConfig("x", "LciProcesses", "inventory", "02-electricity", "file:///x", "zip", "parquet"))
        with pytest.raises(Exception, match=message):
            s.transform(readers.read(spark, str(tmp_path / "b.zip"), "zip")).collect()


# --- flows, factors, products ------------------------------------------------------------------


def ef(tmp_path):
    same = {"xkos:sourceConcept": {"@id": "s:1"}, "xkos:targetConcept": {"@id": "t:1"}, "xkos:mapType": {"@id": "skos#exactMatch"}}
    flows = [
        {"identifier": "abc", "source": "EF 3.1", "prefLabel": " CO2 ", "altLabel": ["<b>carbonic</b>  acid", "co2", "Carbonic acid"], "cas_numbers": ["1", "2"], "ec_numbers": ["9", ""], "context_iri": "https://b/flow-contexts/envi-air-low", "properties": {"https://w3id.org/chemrof/molecular_formula": ["CO2", "x"]}, "definition": [], "concept_associations": [same, same | {"xkos:mapType": {"@id": "closeMatch"}}]},
        {"identifier": "def", "source": "EF 3.1", "prefLabel": "Ore", "context_iri": "https://b/flow-contexts/reso-grou/", "properties": {"https://w3id.org/chemrof/molecular_formula": "Fe"}, "definition": " text "},
        {"identifier": "zzz", "source": "other", "prefLabel": "Z"},
    ]
    path = tmp_path / "f.json.gz"
    path.write_bytes(gzip.compress(json.dumps({"schema_version": 1, "flows": flows}).encode()))
    return path


def test_flow_list(spark, tmp_path):
    s = families.source(SourceConfig("x", "EfFlows", "vocab", "elementary-flows", ef(tmp_path).as_uri(), "json-gz", "parquet"))
    a, b = rows(s.transform(s.read(spark, RunContext(cache_dir=tmp_path / "c"))))
    assert (a["pref_label"], a["alt_labels"], a["cas_number"], a["formula"], a["definition"], a["compartment"]) == ("CO2", ["carbonic acid"], "1", "CO2", None, "air")
    assert a["additional_notations"] == ["ec:9", "bw-context:envi-air-low"] and a["exact_match"] == ["s:1", "t:1"]
    assert (b["formula"], b["definition"], b["compartment"], b["alt_labels"]) == ("Fe", "text", "natural resource", None)
    one = families.source(SourceConfig("x", "EfFlows", "vocab", "elementary-flows", "", "json-gz", "parquet", emit="natural-resource"))
    assert [r["iri"] for r in rows(one.transform(readers.read(spark, str(ef(tmp_path)), "json-gz")))] == ["https://vocab.example/flows/def"]


def factors(tmp_path):
    data = {"FLOW_uuid": ["u1", "u2", "u1", "u1", None], "FLOW_name": ["a", None, "a", "b", "c"], "LCIAMethod_name": ["Climate change", "Climate change ", "Acidification", "Climate change", "Noise"], "CF EF3.1": [1.0, 2.0, 3.0, 9.0, 1.0], "LCIAMethod_location": [None, "FR", None, None, None], "FLOW_class0": ["E", "E", "", None, "x"], "FLOW_class1": [" air", None, None, None, None], "FLOW_class2": [""] * 5, "unused": [1] * 5}
    pq.write_table(pa.table(data), tmp_path / "cf.parquet")
    return tmp_path / "cf.parquet"


def test_factor_table(spark, tmp_path):
    ctx, url = RunContext(cache_dir=tmp_path / "c"), factors(tmp_path).as_uri()
    run = lambda f: rows((s := families.source(SourceConfig("x", f, "methods", "m", url, "parquet", "parquet"))).transform(s.read(spark, ctx)))
    cf = run("EfFactors")
    assert [(r["method_id"], r["flow"].rsplit("/", 1)[1], r["factor_value"], r["unit"], r["location"], r["flow_context"], r["flow_name"]) for r in cf] == [("ef-3.1:climate-change", "u1", 1.0, "kg CO2 eq", None, "E / air", "a"), ("ef-3.1:climate-change", "u2", 2.0, "kg CO2 eq", "FR", "E", ""), ("ef-3.1:acidification", "u1", 3.0, "mol H+ eq", None, None, "a")]
    assert [(r["impact_category"], r["unit"]) for r in run("EfMethods")] == [("Climate change", "kg CO2 eq"), ("Acidification", "mol H+ eq"), ("Noise", "")]
    assert run("EfMethodTerm")[0]["impact_categories"] == [r["iri"] for r in run("EfImpactTerms")]


def test_products(spark, tmp_path):
    head = ["Code\nAGB", "Code\nCIQUAL", "Groupe d'aliment", "Sous-groupe d'aliment", "Nom du Produit en Français", "LCI Name"]
    body = [["11172", "7", "viandes, œufs", "œufs", "Oeuf  dur", "Egg"], ["6582", "", "Viandes, œufs", "", "Boeuf", "boeuf"], ["", "1", "g", "s", "n", ""], ["11172", "8", "autre", "œufs", "Doublon", ""]]
    grid = [["p"] * 6, [""] * 6, head, *body]
    pq.write_table(pa.table({str(i): [r[i] for r in grid] for i in range(6)}), tmp_path / "p.parquet")
    url, ctx = (tmp_path / "p.parquet").as_uri(), RunContext(cache_dir=tmp_path / "c")
    run = lambda f: rows((s := families.source(SourceConfig("x", f, "vocab", "products", url, "parquet", "parquet"))).transform(s.read(spark, ctx)))
    got = run("Products")
    base = "https://vocab.example/products/agribalyse"
    assert [r["iri"].removeprefix(base) for r in got] == ["/group/viandes-ufs", "/subgroup/ufs", "/11172", "/6582", "/group/autre"]
    assert (got[1]["broader"], got[2]["notation"], got[2]["alt_labels"], got[2]["additional_notations"], got[2]["pref_label"]) == (f"{base}/group/viandes-ufs", "7", ["Egg"], ["agb:11172", "ciqual:7"], "Oeuf dur")
    assert (got[3]["broader"], got[3]["notation"], got[3]["alt_labels"]) == (None, "6582", None)
    assert [(r["pref_label"], r["alt_labels"]) for r in run("SheetProcesses")] == [("Egg", ["Oeuf dur"]), ("boeuf", None)]


# --- registry and pipeline -----------------------------------------------------------------------


def test_registry(tmp_path):
    every = registry.builtin()
    assert len(every) == 61 == len({c.name for c in every}) and [c.name for c in every if c.enabled] == ["example-csv"]
    assert all(c.family in families.FAMILIES for c in every)
    (tmp_path / "r.yaml").write_text("sources:\n- {name: mine, family: DemoCsv, target: inventory, category: x, url: 'file:///a', format: csv, output: json}\n")
    assert registry.get("mine", registry.load(tmp_path / "r.yaml")).family == "DemoCsv"
    (tmp_path / "r.yaml").write_text("sources:\n- {name: mine, odd: 1}\n")
    with pytest.raises(RegistryError):
        registry.load(tmp_path / "r.yaml")
    with pytest.raises(RegistryError):
        registry.get("nothing")


def test_demo_end_to_end(spark, tmp_path, capsys):
    from quernstone.__main__ import main

    common = ["--cache-dir", str(tmp_path / "c"), "--output-dir", str(tmp_path / "o")]
    assert main(["run", "--all", *common]) == 0
    assert json.loads((tmp_path / "o/inventory/example/example-csv.json").read_text()) == [{"id": "1", "label": "Alpha Widget", "region": "EU"}, {"id": "2", "label": "Beta Widget", "region": "US"}, {"id": "3", "label": "Gamma Widget", "region": "EU"}]
    assert main(["validate", "example-csv", *common]) == 0 and "3 rows valid" in capsys.readouterr().out
    assert main(["list"]) == 0 and "example-csv" in capsys.readouterr().out
    assert main(["run", "nothing", *common]) == 1 and "error:" in capsys.readouterr().err
    assert main(["run", *common]) == 1


SCHEMA = """
classes:
  SourceCollection: {attributes: {scheme: {required: true}, sources: {multivalued: true, range: Source}}}
  Source: {attributes: {iri: {identifier: true, required: true}, pref_label: {required: true}, title: , creators: {multivalued: true}, publisher: , identifier: , citation: , status: }}
"""


def test_collection_policy_and_delivery(spark, tmp_path):
    import yaml

    (tmp_path / "schemas").mkdir()
    (tmp_path / "schemas/source.yaml").write_text(SCHEMA)
    root = tmp_path / "root"
    (root / "data/sources").mkdir(parents=True)
    (root / "data/sources/bafu-2026.json").write_text("old")
    config = registry.get("bafu-2026-source")
    ctx = RunContext(tmp_path / "c", tmp_path / "o", schema_dir=tmp_path / "schemas", existing_root=root, deliver_root=root)
    out = pipeline.run(spark, config, ctx)
    doc = yaml.safe_load(out.read_text())
    assert doc["scheme"] == "https://vocab.example/sources/" and len(doc["sources"]) == 1
    assert [p.name for p in (root / "data/sources").iterdir()] == ["bafu-2026.yaml"]
    from dataclasses import replace

    assert pipeline.validate(spark, replace(config, check_existing=True), ctx) == 0  # published already: skipped


def test_mapping_package(spark, tmp_path):
    pq.write_table(pa.table({"source_name": ["CO2"], "source_category": ["air"], "source_subcategory": ["nan"], "source_unit": ["kg"], "target_code": ["c"], "target_name": ["t"], "target_unit": ["kg"], "target_categories": [["E"]], "unit_conversion": [2.0], "tier": ["T3"], "target_db": ["ef"], "candidate_count": [1]}), tmp_path / "m.parquet")
    from dataclasses import replace

    config = replace(registry.get("bafu-ef-biosphere"), url=(tmp_path / "m.parquet").as_uri())
    doc = json.loads(pipeline.run(spark, config, RunContext(tmp_path / "c", tmp_path / "o")).read_text())
    assert doc["name"] == config.package_name and doc["replace"][0]["conversion_factor"] == 2.0 and doc["replace"][0]["source"]["context"] == ["air"] and "comment" in doc["replace"][0]


def test_family_shares_one_parse(spark, tmp_path, inventory):
    from dataclasses import replace

    configs = [replace(registry.get(n), url=inventory.as_uri()) for n in ("bafu-electricity-processes", "bafu-electricity-exchanges", "bafu-energy-processes")]
    out = pipeline.run_family(spark, configs, RunContext(tmp_path / "c", tmp_path / "o"))
    assert [pq.read_table(p).num_rows for p in out[:3]] == [1, 4, 1]
    meta = json.loads(out[3].read_text())
    assert (meta["sector"], meta["title"], meta["rank"], meta["row_counts"]) == ("electricity", "Electricity", 2, {"exchanges.parquet": 4, "processes.parquet": 1})


def test_rows_of_several_files_follow_one_another(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    for name, values in (("b", [3, 4]), ("a", [1, 2])):
        pq.write_table(pa.table({"x": values}), tmp_path / f"a b/{name}.parquet")
    got = readers.parquet(spark, str(tmp_path / "a b")).collect()
    assert [r.x for r in sorted(got, key=lambda r: r.ord)] == [1, 2, 3, 4] and len({r.ord for r in got}) == 4


def test_hooks_may_be_overridden(spark):
    class Mine(families.Food):
        def pref_label(self):
            return F.upper("termExtendedName")

        def definition(self):
            return F.lit("mine")

    df = spark.createDataFrame([(0, "A1", "apple", None, "note£x", None, None, {})], "ord bigint, termCode string, termExtendedName string, termShortName string, termScopeNote string, status string, parentCode string, attrs map<string,array<string>>")
    row = Mine(SourceConfig("x", "Mine", "vocab", "products", "u", "ecf", "parquet")).transform(df).first()
    assert (row.pref_label, row.definition, row.notation) == ("APPLE", "mine", "A1")


def test_a_checked_source_needs_the_checkout(spark, tmp_path):
    from dataclasses import replace

    config = replace(registry.get("bafu-2026-source"), check_existing=True)
    with pytest.raises(ValidationError):
        pipeline.validate(spark, config, RunContext(tmp_path / "c", tmp_path / "o"))


def test_shard_command(tmp_path, capsys):
    from quernstone.__main__ import main

    pq.write_table(pa.table({"x": list(range(1000))}), tmp_path / "t.parquet")
    assert main(["shard", str(tmp_path / "t.parquet"), "--limit", "2000"]) == 0
    assert sum(pq.read_metadata(f).num_rows for f in tmp_path.glob("t-*.parquet")) == 1000
    assert main(["shard", str(tmp_path / "none.parquet")]) == 1


def test_audit(spark, tmp_path, inventory, capsys):
    from dataclasses import replace

    from quernstone.__main__ import main
    from quernstone.plans.audit import audit

    names = [c for c in registry.builtin() if c.name.startswith("bafu-") and c.format == "zip" and c.target == "inventory"] + [registry.get("bafu-elementary-flows-emissions-to-air")]
    out = tmp_path / "o"
    configs = [replace(c, url=inventory.as_uri(), collection=None, item_class=None) for c in names]
    pipeline.run_family(spark, configs, RunContext(tmp_path / "c", out, existing_root=tmp_path))
    products = spark.createDataFrame([("Power - CH",), ("Power - US-CH",), ("CrÃ¨me - FR",), (None,)], "product string")
    got = {r["check"]: (r["ok"], r["detail"]) for r in audit(spark, out, 3, products).collect()}
    assert got["there are 3 processes"] == (True, "3") and got["process ids are unique"][0]
    assert got["inputs and products are processes"] == (False, "1")  # number 999 is nowhere
    assert got["biosphere flows are terms"][0] and got["exchanges belong to processes"][0]
    assert got["workbook products are covered"] == (False, "1") and got["02-electricity/metadata.json is complete"][0]
    assert main(["audit", "--output-dir", str(out)]) == 1 and "FAIL inputs" in capsys.readouterr().out
    assert audit(spark, tmp_path / "none").collect()[-1]["ok"] is False
