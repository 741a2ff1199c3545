"""The families of sources: what to read and how to turn it into contract rows.

Every transform is lazy and takes and returns DataFrames with ``ord``, the position rows keep.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.errors import RegistryError
from quernstone.functions import arrays, ids, routing, text
from quernstone.model import CONTRACTS, RunContext, SourceConfig
from quernstone.operators import assemble, dedup, resolve
from quernstone.sources import readers
from quernstone.sources.fetch import fetch


def shaped(df: DataFrame, contract: str) -> DataFrame:
    """``ord`` and the contract's columns in order; absent ones are null of the declared type."""
    fields = T._parse_datatype_string(CONTRACTS[contract]).fields
    return df.select("ord", *((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


class Source(ABC):
    """A source: ``read`` gives records, ``transform`` contract rows."""

    def __init__(self, config: SourceConfig, base: str = ids.BASE) -> None:
        self.config, self.base = config, base

    def read(self, spark: SparkSession, ctx: RunContext) -> DataFrame:
        return readers.read(spark, fetch(self.config.url, ctx), self.config.format)

    @abstractmethod
    def transform(self, df: DataFrame) -> DataFrame: ...

    def iri(self, *parts) -> F.Column:
        return ids.iri(*parts, base=self.base)

    def source(self, name: str) -> F.Column:
        return F.lit(f"{self.base}/sources/{name}")


class DemoCsv(Source):
    """id, name, region to id, label, region; labels in title case."""

    def read(self, spark: SparkSession, ctx: RunContext) -> DataFrame:
        if self.config.url.startswith("bundled://"):
            return readers.csv(spark, str(Path(__file__).parent / "data" / self.config.url.removeprefix("bundled://")))
        return super().read(spark, ctx)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select("ord", "id", text.title_any("name").alias("label"), "region")


class Static(Source):
    """One bibliographic record from the registry."""

    def read(self, spark: SparkSession, ctx: RunContext) -> DataFrame:
        o = self.config.options
        return spark.createDataFrame([(0, f"{self.base}/sources/{o['id']}", o["label"], o["title"], list(o["creators"]), o["publisher"], o["identifier"], o["citation"], "draft")], "ord bigint, iri string, pref_label string, title string, creators array<string>, publisher string, identifier string, citation string, status string")

    def transform(self, df: DataFrame) -> DataFrame:
        return df


class Food(Source):
    """Food-classification terms to concepts of one category."""

    prefix = "foodex2"

    # Hooks: each gives one field as a Column over the term's record; a family of one's own may override any.

    def attr(self, k: str) -> F.Column:
        return F.try_element_at("attrs", F.lit(k))

    def classify(self) -> F.Column:
        return routing.term_category(self.attr("termType"))

    def notation(self) -> F.Column:
        return F.when(F.col("termCode") != "", F.col("termCode"))

    def pref_label(self) -> F.Column:
        return F.coalesce(text.stripped(F.col("termExtendedName")), F.lit(""))

    def definition(self) -> F.Column:
        return text.before(F.col("termScopeNote"), "£")

    def alt_labels(self) -> F.Column:
        short = F.when(F.col("termShortName").isNotNull(), F.array("termShortName"))
        return arrays.alt_labels(F.col("pref_label"), short, self.attr("A02"), self.attr("A01"))

    def additional_notations(self) -> F.Column:
        legacy = F.concat(*(arrays.prefixed(self.attr(k), p) for k, p in routing.LEGACY_CODES))
        return arrays.empty_to_null(arrays.dedupe(legacy))

    def broader(self, rows: DataFrame, index: DataFrame) -> DataFrame:
        """``rows`` with ``broader``, the identifier of the parent."""
        return resolve.broader(rows, index, self.prefix, self.base)

    def related(self, df: DataFrame, index: DataFrame) -> DataFrame:
        """(ord, related) of all terms."""
        return resolve.related(df, index, self.prefix, self.base)

    def make_iri(self, category: F.Column) -> F.Column:
        """The identifier, ``category`` being that of the code's last term."""
        code = resolve.code_iri(category, F.col("notation"), self.prefix, self.base)
        return ids.code_or_slug_iri(code, F.col("pref_label"), self.config.category, self.prefix, base=self.base)

    def transform(self, df: DataFrame) -> DataFrame:
        index = resolve.code_index(df, "ord")
        rows = df.withColumn("category", self.classify()).withColumn("pref_label", self.pref_label()).withColumn("notation", self.notation())
        rows = rows.where((F.col("category") == self.config.category) & (F.col("pref_label") != ""))
        # a code's category is that of its last term
        own = index.select(F.col("code").alias("o_code"), F.col("category").alias("o_category"))
        rows = rows.join(own, F.col("notation") == F.col("o_code"), "left")
        rows = self.broader(rows, index).join(self.related(df, index), "ord", "left")
        fields = [self.make_iri(F.col("o_category")).alias("iri"), self.alt_labels().alias("alt_labels"), self.definition().alias("definition"), self.additional_notations().alias("additional_notations")]
        return shaped(rows.select("ord", "pref_label", "notation", "broader", "related", *fields, routing.status(F.col("status")).alias("status"), self.source("foodex2").alias("source")), "concept")


class EfFlows(Source):
    """The harmonised flow list to flow terms, of one compartment where ``emit`` names it."""

    wanted = "EF 3.1"

    def transform(self, df: DataFrame) -> DataFrame:
        c = routing.context_compartment(F.col("context_iri"))
        rows = df.where(F.col("source") == self.wanted).withColumn("pref_label", text.blank_to_null(F.col("prefLabel"))).where((F.coalesce(F.col("identifier"), F.lit("")) != "") & F.col("pref_label").isNotNull()).withColumn("compartment", c)
        if self.config.emit:
            lost = F.raise_error(F.concat(F.lit("no compartment for flow "), F.col("identifier")))
            rows = rows.where(text.compartment_slug(F.coalesce("compartment", lost)) == self.config.emit)
        formula = F.try_element_at("properties", F.lit("https://w3id.org/chemrof/molecular_formula"))
        formula = F.when(F.startswith(formula, F.lit("[")), F.get_json_object(formula, "$[0]")).otherwise(formula)
        definition = F.when(F.col("definition") != "[]", text.blank_to_null(F.col("definition")))
        same = F.transform("concept_associations", lambda a: F.struct(a["xkos:mapType"]["@id"].alias("type"), a["xkos:sourceConcept"]["@id"].alias("source"), a["xkos:targetConcept"]["@id"].alias("target")))
        ec = F.filter(F.coalesce("ec_numbers", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
        context = routing.context_segment(F.col("context_iri"))
        notations = F.concat(arrays.prefixed(ec, "ec"), F.when(context.isNotNull(), F.array(F.concat(F.lit("bw-context:"), context))).otherwise(F.array().cast("array<string>")))
        return shaped(
            rows.select(
                "ord", "pref_label", "compartment", self.iri("flows", F.col("identifier")).alias("iri"), arrays.alt_labels(F.col("pref_label"), F.transform("altLabel", text.strip_html)).alias("alt_labels"), definition.alias("definition"),
                arrays.first_element(F.col("cas_numbers")).alias("cas_number"), F.when(formula != "", formula).alias("formula"), arrays.empty_to_null(notations).alias("additional_notations"),
                arrays.empty_to_null(arrays.exact_matches(same)).alias("exact_match"), self.source("ef-3.1").alias("source"), F.lit("draft").alias("status"),
            ),
            "flow",
        )


class EfTable(Source):
    """Base of what comes out of the factor table."""

    datasource, method, citation = "ef-3.1", "EF v3.1", "European Commission, Joint Research Centre — Environmental Footprint (EF) 3.1"

    def read(self, spark: SparkSession, ctx: RunContext) -> DataFrame:
        return readers.factor_table(spark, str(fetch(self.config.url, ctx)))

    def impacts(self, df: DataFrame) -> DataFrame:
        return dedup.distinct_ordered(df, "method_name")

    def impact_iri(self) -> F.Column:
        return ids.slug_iri(F.col("method_name"), "impact-categories", self.datasource, base=self.base)


class EfMethods(EfTable):
    def transform(self, df: DataFrame) -> DataFrame:
        m = F.col("method_name")
        return shaped(self.impacts(df).select("ord", ids.method_id(m, self.datasource).alias("method_id"), F.lit(self.method).alias("method_name"), m.alias("impact_category"), routing.reference_unit(m).alias("unit"), F.lit("EF").alias("methodology"), F.lit(self.citation).alias("source"), F.lit(self.datasource).alias("datasource")), "method")


class EfFactors(EfTable):
    """Factors, the first of each (impact category, flow, location); a null location is one of them."""

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df.where((F.coalesce("flow_uuid", F.lit("")) != "") & (F.col("method_name") != "") & F.col("cf").isNotNull())
        rows = dedup.first_wins(rows, ["method_name", "flow_uuid", "location"])
        names = rows.select("method_name").distinct().withColumn("method_id", ids.method_id(F.col("method_name"), self.datasource))
        m = F.col("method_name")
        rows = rows.join(names, "method_name")
        return shaped(rows.select("ord", "method_id", m.alias("impact_category"), self.iri("flows", F.col("flow_uuid")).alias("flow"), F.coalesce("flow_name", F.lit("")).alias("flow_name"), F.col("cf").cast("double").alias("factor_value"), routing.reference_unit(m).alias("unit"), "flow_context", F.when(F.col("location") != "", F.col("location")).alias("location")), "factor")


class EfMethodTerm(EfTable):
    """One term with the list of its impact categories."""

    def transform(self, df: DataFrame) -> DataFrame:
        one = dedup.collect_ordered(self.impacts(df).withColumn("one", F.lit(0)), ["one"], self.impact_iri(), "ord", "impact_categories")
        return one.select(F.lit(0).cast("bigint").alias("ord"), self.iri("lcia-methods", F.lit(self.datasource)).alias("iri"), F.lit(self.method).alias("pref_label"), F.lit("EF").alias("methodology"), "impact_categories", self.source(self.datasource).alias("source"), F.lit("draft").alias("status"))


class EfImpactTerms(EfTable):
    def transform(self, df: DataFrame) -> DataFrame:
        return self.impacts(df).select("ord", self.impact_iri().alias("iri"), F.col("method_name").alias("pref_label"), self.iri("lcia-methods", F.lit(self.datasource)).alias("method"), self.source(self.datasource).alias("source"), F.lit("draft").alias("status"))


class SheetSource(Source):
    prefix = "agribalyse"

    def read(self, spark: SparkSession, ctx: RunContext) -> DataFrame:
        return readers.product_sheet(spark, str(fetch(self.config.url, ctx)))

    def some(self, c: str) -> F.Column:
        return F.when(F.col(c) != "", F.col(c))


class Products(SheetSource):
    """Groups, subgroups and products with ``broader``; of equal identifiers the first row stays."""

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df.where((F.col("agb") != "") & (F.col("name_fr") != ""))
        at = lambda level: (F.col("ord") * 3 + level).alias("ord")
        gi, si = ids.slug_iri(F.col("group"), "products", self.prefix, "group", base=self.base), ids.slug_iri(F.col("subgroup"), "products", self.prefix, "subgroup", base=self.base)
        groups = rows.where("`group` != ''").select(at(0), gi.alias("iri"), F.col("group").alias("pref_label"))
        subs = rows.where("subgroup != ''").select(at(1), si.alias("iri"), F.col("subgroup").alias("pref_label"), F.when(F.col("group") != "", gi).alias("broader"))
        lci = F.when((F.col("lci_name") != "") & (text.folded(F.col("lci_name")) != text.folded(F.col("name_fr"))), F.array("lci_name"))
        extra = F.filter(F.array(F.concat(F.lit("agb:"), F.col("agb")), F.when((F.col("ciqual") != "") & (F.col("ciqual") != F.col("agb")), F.concat(F.lit("ciqual:"), F.col("ciqual")))), lambda x: x.isNotNull())
        items = rows.select(at(2), self.iri("products", self.prefix, F.col("agb")).alias("iri"), F.col("name_fr").alias("pref_label"), F.coalesce(self.some("ciqual"), "agb").alias("notation"), lci.alias("alt_labels"), extra.alias("additional_notations"), F.when(F.col("subgroup") != "", si).alias("broader"))
        every = groups.unionByName(subs, True).unionByName(items, True).withColumn("source", self.source("agribalyse-3.2")).withColumn("status", F.lit("draft"))
        return dedup.first_wins(shaped(every, "concept"), ["iri"])


class SheetProcesses(SheetSource):
    """The life-cycle process of every product."""

    def transform(self, df: DataFrame) -> DataFrame:
        label = F.coalesce(self.some("lci_name"), self.some("name_fr"))
        rows = df.withColumn("pref_label", label).where((F.col("agb") != "") & F.col("pref_label").isNotNull())
        alt = F.when((F.col("name_fr") != "") & (text.folded(F.col("name_fr")) != text.folded(F.col("pref_label"))), F.array("name_fr"))
        terms = rows.select("ord", self.iri("processes", self.prefix, F.col("agb")).alias("iri"), "pref_label", F.coalesce(self.some("ciqual"), "agb").alias("notation"), F.lit("lci_result").alias("process_type"), F.array(self.iri("products", self.prefix, F.col("agb"))).alias("related"), F.array(F.concat(F.lit("agb:"), F.col("agb"))).alias("additional_notations"), alt.alias("alt_labels"), self.source("agribalyse-3.2").alias("source"), F.lit("draft").alias("status"))
        return dedup.first_wins(shaped(terms, "process_term"), ["iri"])


class LciSource(Source):
    citation = "Life Cycle Inventory database of the Swiss Federal Administration, BAFU:2026"

    def sliced(self, df: DataFrame, by_slug: str | None = None) -> DataFrame:
        """Datasets of one sector; the sector of every dataset is told, so an unknown category stops any slice."""
        routed = df.withColumn("sector", routing.sector(F.col("category")))
        if by_slug is not None:
            return routed.where(routing.sector_slug(F.col("sector")) == by_slug)
        return routed.where(F.col("sector") == self.config.category)


class LciProcesses(LciSource):
    def transform(self, df: DataFrame) -> DataFrame:
        note = text.comment(F.col("category"), F.col("subcategory"), F.col("obsolete"), "obsolete/not maintained in BAFU:2026", self.citation, "BAFU category")
        return shaped(self.sliced(df).select("ord", F.col("uuid").alias("process_id"), "name", F.col("name").alias("reference_product"), F.col("unit").alias("reference_unit"), F.col("amount").alias("reference_amount"), "location", F.lit("unit").alias("process_type"), "technology", note.alias("comment")), "process")


class LciExchanges(LciSource):
    """Exchanges of one sector; inputs are resolved against the numbers of all sectors."""

    def transform(self, df: DataFrame) -> DataFrame:
        index = resolve.last_wins(df, "number", F.col("uuid"), "ord").select("number", F.col("value").alias("uuid"))
        rows = assemble.exchange_rows(self.sliced(df), index)
        return shaped(rows.withColumn("ord", F.col("ord") * 1_000_000 + F.col("at")), "exchange")


class LciFlowTerms(LciSource):
    """Distinct biosphere flows; the registry number of the first mention."""

    def transform(self, df: DataFrame) -> DataFrame:
        x = df.select("ord", F.posexplode("exchanges").alias("at", "x")).select((F.col("ord") * 1_000_000 + F.col("at")).alias("ord"), "x.*").where("group_code = 4")
        if self.config.emit:
            x = x.where(text.compartment_slug(F.coalesce("category", F.lit(""))) == self.config.emit)
        x = dedup.first_wins(x.withColumn("fid", ids.flow_id(F.col("name"), F.col("category"), F.col("subcategory"))), ["fid"])
        return shaped(x.select("ord", self.iri("flows", F.col("fid")).alias("iri"), F.col("name").alias("pref_label"), F.col("fid").alias("notation"), F.col("category").alias("compartment"), F.col("subcategory").alias("sub_compartment"), F.when(F.col("cas") != "", F.col("cas")).alias("cas_number"), self.source("bafu-2026").alias("source"), F.lit("draft").alias("status")), "flow")


class LciProcessTerms(LciSource):
    def transform(self, df: DataFrame) -> DataFrame:
        rows = self.sliced(df, self.config.emit) if self.config.emit else df
        d = F.btrim(text.definition(F.col("general_comment"), F.col("obsolete")))
        return shaped(rows.select("ord", self.iri("processes", "bafu", F.col("uuid")).alias("iri"), F.col("name").alias("pref_label"), F.col("uuid").alias("notation"), F.lit("unit").alias("process_type"), d.alias("definition"), self.source("bafu-2026").alias("source"), F.lit("draft").alias("status")), "process_term")


class CuratedMappings(Source):
    #: The columns of the delivered table.
    columns = ["source_name", "source_unit", "source_context", "source_cas", "target_db", "target_code", "target_name", "target_unit", "unit_conversion", "priority_tier", "provenance"]

    def transform(self, df: DataFrame) -> DataFrame:
        o = self.config.options
        return numbered(assemble.curated_entries, df.select("ord", *self.columns), o["allowed"], o["barred"], o["dropped"])


class DebridgedMappings(Source):
    #: The columns of the delivered table.
    columns = ["source_name", "source_category", "source_subcategory", "source_unit", "target_code", "target_name", "target_unit", "target_categories", "unit_conversion", "tier", "target_db"]

    def transform(self, df: DataFrame) -> DataFrame:
        return numbered(assemble.crosswalk_entries, df.select("ord", *self.columns), "ef", self.config.options["notes"])


def numbered(build, df: DataFrame, *args) -> DataFrame:
    """``build`` with the rows' ``ord`` carried along."""
    return build(df, *args, keep=["ord"])


FAMILIES: dict[str, type[Source]] = {
    c.__name__: c for c in (DemoCsv, Static, Food, EfFlows, EfMethods, EfFactors, EfMethodTerm, EfImpactTerms, Products, SheetProcesses, LciProcesses, LciExchanges, LciFlowTerms, LciProcessTerms, CuratedMappings, DebridgedMappings)
}


def register(family: type[Source]) -> None:
    """Adds a family of one's own."""
    FAMILIES[family.__name__] = family


def source(config: SourceConfig, base: str = ids.BASE) -> Source:
    try:
        return FAMILIES[config.family](config, base)
    except KeyError:
        raise RegistryError(f"no family named {config.family!r}") from None
