"""Formats to DataFrames. Every reader takes (spark, path) and adds ``ord``, the position in the file."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.etree import ElementTree as ET

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.errors import ParseError
from quernstone.functions import routing, text
from quernstone.operators import infer
from quernstone.sources import turtle, xlsx

Reader = Callable[[SparkSession, str], DataFrame]
_READERS: dict[str, Reader] = {}


def register(format: str, reader: Reader) -> None:
    """Adds a format or replaces it."""
    _READERS[format] = reader


def read(spark: SparkSession, path: str | Path, format: str) -> DataFrame:
    try:
        reader = _READERS[format]
    except KeyError:
        raise ParseError(f"no reader for {format!r}") from None
    return reader(spark, str(path))


def _numbered(df: DataFrame) -> DataFrame:
    """Row position of a scan, before any shuffle."""
    return df.withColumn("ord", F.monotonically_increasing_id())


def csv(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 with a header; every column is a string, empty cells are ''."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return _numbered(df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns)))


def _document(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Rows of a small document; columns in order of first sight, mixed kinds become strings."""
    schema = infer.record_schema(records).add("ord", T.LongType())
    rows = [tuple(_fit(r.get(f.name), f.dataType) for f in schema.fields[:-1]) + (i,) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, schema)


def _fit(v, kind: T.DataType):
    as_text = lambda x: x if isinstance(x, str) else json.dumps(x, ensure_ascii=False, default=str) if isinstance(x, (dict, list)) else str(x)
    if v is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [as_text(x) for x in (v if isinstance(v, list) else [v])]
    return as_text(v) if isinstance(kind, T.StringType) else float(v) if isinstance(kind, T.DoubleType) else v


def _root(value: object, what: str) -> list[dict]:
    if isinstance(value, dict):
        return [value]
    if isinstance(value, list) and all(isinstance(v, dict) for v in value):
        return value
    raise ParseError(f"the root of a {what} document is an object or a list of objects")


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """An object is one row, an array of objects as many rows; read by Spark, so the file may be large."""
    df = spark.read.option("multiLine", True).json(path)
    if not df.columns or df.columns == ["_corrupt_record"]:
        raise ParseError("the root of a JSON document is an object or a list of objects")
    return _numbered(df)


def yaml_document(spark: SparkSession, path: str) -> DataFrame:
    return _document(spark, _root(yaml.safe_load(Path(path).read_text("utf-8")), "YAML"))


def turtle_document(spark: SparkSession, path: str) -> DataFrame:
    rows = list(turtle.triples(Path(path).read_text("utf-8")))
    return spark.createDataFrame([(r["subject"], r["predicate"], r["object"], i) for i, r in enumerate(rows)], "subject string, predicate string, object string, ord bigint")


def workbook(spark: SparkSession, path: str) -> DataFrame:
    return _document(spark, xlsx.records(Path(path).read_bytes()))


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columns as they are; ``ord`` is the row's position in its file, files following one another by name."""
    df = spark.read.parquet(path)
    files, row = sorted(df.inputFiles()), F.col("_metadata.row_index")
    if len(files) < 2:
        return df.select("*", row.alias("ord"))
    bare = lambda c: F.url_decode(F.regexp_replace(c, "^[a-z0-9]+:/+", "/"))
    ranks = spark.createDataFrame(list(enumerate(files)), "f_rank bigint, f_name string").select("f_rank", bare(F.col("f_name")).alias("f_name"))
    rows = df.select("*", row.alias("f_row"), bare(F.col("_metadata.file_path")).alias("f_path"))
    return rows.join(ranks, F.col("f_path") == F.col("f_name")).withColumn("ord", F.shiftleft("f_rank", 40) + F.col("f_row")).drop("f_row", "f_path", "f_rank", "f_name")


# --- families' own formats ---------------------------------------------------------------------

_TERM = """termDesc struct<termCode:string,termExtendedName:string,termShortName:string,termScopeNote:string>,
  termVersion struct<status:string>,
  hierarchyAssignments struct<hierarchyAssignment:array<struct<hierarchyCode:string,parentCode:string>>>,
  implicitAttributes struct<implicitAttribute:array<struct<attributeCode:string,attributeValues:struct<attributeValue:array<string>>>>>"""


def _term_fragments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The <term> elements of zipped catalogues, streamed so that no catalogue is held as a tree."""
    for b in batches:
        for content in b["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                name = next((n for n in z.namelist() if n.lower().endswith(".xml")), None)
                if name is None:
                    raise ParseError("the archive has no XML member")
                out, n = [], 0
                with z.open(name) as f:
                    for _, e in ET.iterparse(f, events=("end",)):
                        if e.tag.rsplit("}", 1)[-1] == "term":
                            out.append((n, ET.tostring(e, "unicode")))
                            n += 1
                            e.clear()
                            if len(out) == 2000:
                                yield pd.DataFrame(out, columns=["ord", "xml"])
                                out = []
                yield pd.DataFrame(out, columns=["ord", "xml"])


def food_terms(spark: SparkSession, path: str, hierarchy: str = "MTX") -> DataFrame:
    """Terms of a zipped catalogue: desc fields, status, attrs (blank values dropped, a later code wins), the master hierarchy's first parent."""
    files = spark.read.format("binaryFile").load(path).select("content")
    xml = files.mapInPandas(_term_fragments, "ord bigint, xml string").repartition(F.col("ord"))
    x = F.from_xml("xml", _TERM)
    t = xml.select("ord", x.alias("x"))
    some = text.blank_to_null
    d = lambda f: some(F.col(f"x.termDesc.{f}")).alias(f)
    pairs = F.filter(
        F.transform(
            F.coalesce("x.implicitAttributes.implicitAttribute", F.array()),
            lambda a: F.struct(some(a["attributeCode"]).alias("k"), F.filter(F.transform(F.coalesce(a["attributeValues"]["attributeValue"], F.array()), some), lambda v: v.isNotNull()).alias("v")),
        ),
        lambda p: p["k"].isNotNull() & (F.size(p["v"]) > 0),
    )
    # of a repeated code the last entry stays
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(F.transform(pairs, lambda q: q["k"]), i + 2, F.size(pairs)), lambda k: k == p["k"]))
    master = F.filter(F.coalesce("x.hierarchyAssignments.hierarchyAssignment", F.array()), lambda h: F.trim(h["hierarchyCode"]) == hierarchy)
    return t.select("ord", d("termCode"), d("termExtendedName"), d("termShortName"), d("termScopeNote"), some(F.col("x.termVersion.status")).alias("status"), some(F.try_element_at(master, F.lit(1))["parentCode"]).alias("parentCode"), F.map_from_entries(last).alias("attrs"))


_DATASET = """dataset struct<_number:string,
  metaInformation:struct<processInformation:struct<
    referenceFunction:struct<_name:string,_category:string,_subCategory:string,_unit:string,_amount:string,_infrastructureProcess:string,_generalComment:string>,
    geography:struct<_location:string>, technology:struct<_text:string>>>,
  flowData:struct<exchange:array<struct<_name:string,_category:string,_subCategory:string,_CASNumber:string,_location:string,_unit:string,_meanValue:string,_number:string,
    _uncertaintyType:string,_standardDeviation95:string,inputGroup:string,outputGroup:string>>>>"""


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for content in b["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for i, name in enumerate(z.namelist()):
                    if name.endswith(".xml"):
                        yield pd.DataFrame({"ord": [i], "member": [name], "xml": [z.read(name).decode("utf-8-sig")]})


def lci_datasets(spark: SparkSession, path: str) -> DataFrame:
    """Datasets of an archive with one XML document each: head fields and exchanges; names are not stripped, as ids hang on them."""
    files = spark.read.format("binaryFile").load(path).select("content")
    xml = files.mapInPandas(_members, "ord bigint, member string, xml string").repartition(F.col("ord"))
    d = xml.select("ord", "member", F.from_xml("xml", _DATASET, {"ignoreSurroundingSpaces": "false"}).alias("x"))
    fail = lambda ok, message, value: F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(message), F.col("member"))))
    ref = F.col("x.dataset.metaInformation.processInformation.referenceFunction")
    empty = lambda c: F.coalesce(c, F.lit(""))
    number = lambda c: F.when(c != "", c).cast("double")
    uuid = F.regexp_extract("member", r"process_(.+)\.xml$", 1)

    def exchange(e):
        inward = e["inputGroup"].isNotNull()
        code = F.btrim(F.when(inward, e["inputGroup"]).otherwise(e["outputGroup"]))
        return F.struct(
            empty(e["_name"]).alias("name"), e["_category"].alias("category"), e["_subCategory"].alias("subcategory"), e["_CASNumber"].alias("cas"), e["_location"].alias("location"),
            empty(e["_unit"]).alias("unit"), F.coalesce(number(e["_meanValue"]), F.lit(0.0)).alias("amount"), empty(e["_number"]).alias("number"),
            F.when(inward, "input").otherwise("output").alias("group"), F.when(code != "", code).cast("int").alias("group_code"),
            e["_uncertaintyType"].alias("uncertainty_type"), number(e["_standardDeviation95"]).alias("sd95"),
        )

    name, category, sub = empty(ref["_name"]), empty(ref["_category"]), empty(ref["_subCategory"])
    return d.select(
        "ord",
        fail(uuid != "", "unexpected file name: ", uuid).alias("uuid"),
        fail(F.col("x.dataset").isNotNull(), "no dataset in ", empty(F.col("x.dataset._number"))).alias("number"),
        fail(ref.isNotNull(), "no referenceFunction in ", name).alias("name"),
        category.alias("category"), sub.alias("subcategory"), empty(ref["_unit"]).alias("unit"), F.coalesce(number(ref["_amount"]), F.lit(1.0)).alias("amount"),
        F.col("x.dataset.metaInformation.processInformation.geography._location").alias("location"), F.col("x.dataset.metaInformation.processInformation.technology._text").alias("technology"),
        (F.coalesce(ref["_infrastructureProcess"], F.lit("false")) == "true").alias("infrastructure"), routing.obsolete(name, category, sub).alias("obsolete"), empty(ref["_generalComment"]).alias("general_comment"),
        F.transform(F.coalesce("x.dataset.flowData.exchange", F.array()), exchange).alias("exchanges"),
    )


_FLOWS = """flows array<struct<identifier:string,source:string,prefLabel:string,altLabel:array<string>,cas_numbers:array<string>,ec_numbers:array<string>,context_iri:string,
  properties:map<string,string>,definition:string,concept_associations:array<struct<`xkos:sourceConcept`:struct<`@id`:string>,`xkos:targetConcept`:struct<`@id`:string>,`xkos:mapType`:struct<`@id`:string>>>>>"""


def flow_list(spark: SparkSession, path: str) -> DataFrame:
    """The ``flows`` of a (gzipped) JSON document; fields of mixed type stay JSON text."""
    df = spark.read.option("multiLine", True).schema(_FLOWS).json(path)
    return df.select(F.posexplode("flows").alias("ord", "f")).select(F.col("ord").cast("bigint").alias("ord"), "f.*")


#: Header labels of the product workbook.
PRODUCT_FIELDS = {"Code AGB": "agb", "Code CIQUAL": "ciqual", "Groupe d'aliment": "group", "Sous-groupe d'aliment": "subgroup", "Nom du Produit en Français": "name_fr", "LCI Name": "lci_name"}


def product_sheet(spark: SparkSession, path: str, header_row: int = 2) -> DataFrame:
    """A Parquet sheet whose header is row ``header_row``; known columns by name, white space collapsed, missing ones null."""
    df = parquet(spark, path)
    cols = [c for c in df.columns if c != "ord"]
    head = df.where(F.col("ord") == header_row).select(*(text.squash(F.col(f"`{c}`")).alias(c) for c in cols)).first()  # one row
    label = {head[c]: c for c in cols} if head else {}
    found = [text.squash(F.col(f"`{label[k]}`")).alias(v) if k in label else F.lit(None).cast("string").alias(v) for k, v in PRODUCT_FIELDS.items()]
    return df.where(F.col("ord") > header_row).select("ord", *found)


#: The columns of the factor table that are needed.
FACTOR_COLUMNS = ["FLOW_uuid", "FLOW_name", "LCIAMethod_name", "CF EF3.1", "LCIAMethod_location", "FLOW_class0", "FLOW_class1", "FLOW_class2"]


def factor_table(spark: SparkSession, path: str) -> DataFrame:
    """Characterization factors; only the columns needed are read."""
    df = parquet(spark, path).select("ord", *(F.col(f"`{c}`") for c in FACTOR_COLUMNS))
    return df.select("ord", F.col("FLOW_uuid").alias("flow_uuid"), F.col("FLOW_name").alias("flow_name"), F.coalesce(text.stripped(F.col("LCIAMethod_name")), F.lit("")).alias("method_name"), F.col("`CF EF3.1`").alias("cf"), F.col("LCIAMethod_location").alias("location"), text.path(F.col("FLOW_class0"), F.col("FLOW_class1"), F.col("FLOW_class2")).alias("flow_context"))


for _format, _reader in {"csv": csv, "json": json_document, "yaml": yaml_document, "ttl": turtle_document, "turtle": turtle_document, "rdf": turtle_document, "xlsx": workbook, "xls": workbook, "parquet": parquet, "ecf": food_terms, "zip": lci_datasets, "json-gz": flow_list}.items():
    register(_format, _reader)
