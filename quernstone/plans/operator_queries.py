"""Queries for the import engine's own operators, over the test tables, each with its SQL.

``QUERIES`` and ``SQL`` have the same keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import arrays, ids, routing, text
from quernstone.functions.keys import key
from quernstone.functions.uncertainty import uncertainty
from quernstone.operators import assemble, checks, dedup, infer, resolve, shard

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# SQL pieces: Unicode white space as the engine strips it
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
strip = lambda c: f"trim({c}, {WS})"
squash = lambda c: f"coalesce(trim(regexp_replace({c}, '[\\s\\x{{0B}}\\x{{85}}\\x{{A0}}]+', ' ', 'g')), '')"
NS = "4b09f7bf2fce5cab8f6537460e420355"


def uuid_sql(s: str) -> str:
    h = f"sha1(unhex('{NS}') || encode({s}))"
    return f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || substr('89ab', (('0x' || substr({h},17,1))::INT % 4) + 1, 1) || substr({h},18,3) || '-' || substr({h},21,12))"


# case folding, of the letters these tables have
fold = lambda c: f"replace(lower({c}), 'ß', 'ss')"
slug = lambda c: f"trim(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-')"
BASE = "https://vocab.example"
NULLS = "('', 'nan', 'none', '<na>')"
denull = lambda c: f"(CASE WHEN {c} IS NULL OR lower({strip(c)}) IN {NULLS} THEN '' ELSE {strip(c)} END)"

NOTE = "split_part(termScopeNote, '£', 1)"


# --- projections, filters, routing -------------------------------------------------------------


@query("""
SELECT p_partkey, list_aggregate(list_transform(regexp_extract_all(trim(p_name), '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') AS label FROM part""")
def q_csv_project_title(spark, d):
    return t(spark, d, "part").select("p_partkey", text.title(F.col("p_name")).alias("label"))


@query("SELECT p_partkey, p_type FROM part WHERE trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') = (SELECT min(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-')) FROM part)")
def q_slice_filter(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_type").withColumn("slug", text.compartment_slug(F.col("p_type")))
    first = p.agg(F.min("slug").alias("wanted"))
    return p.join(F.broadcast(first), F.col("slug") == F.col("wanted")).select("p_partkey", "p_type")  # one row


@query("""
SELECT name, trim(regexp_replace(lower(regexp_replace(nfkd, '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-') AS slug
FROM (SELECT DISTINCT pref_label AS name, strip_accents(pref_label) AS nfkd FROM concepts WHERE pref_label IS NOT NULL)""")
def q_slugify(spark, d):
    return t(spark, d, "concepts").where("pref_label is not null").select(F.col("pref_label").alias("name")).distinct().withColumn("slug", text.slugify_any("name"))


@query("SELECT rec_id, trim(regexp_replace(lower(compartment), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM flows")
def q_compartment_slug(spark, d):
    return t(spark, d, "flows").select("rec_id", text.compartment_slug(F.col("compartment")).alias("slug"))


@query(f"SELECT {fold(squash('source_name'))} AS label, count(*) AS n FROM crosswalk GROUP BY 1")
def q_normalize_label(spark, d):
    return t(spark, d, "crosswalk").groupBy(text.normalize_label(F.col("source_name")).alias("label")).agg(F.count("*").alias("n"))


@query(f"""
WITH v AS (SELECT rec_id, name FROM processes WHERE name IS NOT NULL UNION ALL SELECT rec_id, replace(upper(name), 'ß', 'SS') FROM processes WHERE name IS NOT NULL)
SELECT rec_id, count(DISTINCT {fold(squash('name'))}) AS n_labels FROM v GROUP BY rec_id""")
def q_label_fold(spark, d):
    """A name and its capitals ("Straße", "STRASSE") are one label."""
    p = t(spark, d, "processes").where("name is not null").select("rec_id", "name")
    both = p.unionByName(p.select("rec_id", F.upper("name").alias("name")))
    return both.groupBy("rec_id").agg(F.count_distinct(text.normalize_label(F.col("name"))).alias("n_labels"))


@query(f"""
SELECT rec_id, {uuid_sql("concat_ws('|', coalesce(source_name,''), coalesce(source_category,''), coalesce(source_subcategory,''))")} AS flow_id FROM crosswalk""")
def q_flow_id(spark, d):
    return t(spark, d, "crosswalk").select("rec_id", ids.flow_id(F.col("source_name"), F.col("source_category"), F.col("source_subcategory")).alias("flow_id"))


@query("""
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_tax > 0 AND l_linenumber % 3 = 1 AND l_extendedprice <> 0 THEN 2 WHEN l_tax > 0 AND l_linenumber % 3 = 2 THEN 3 END AS BIGINT) AS uncertainty_type,
  round(CASE WHEN l_tax > 0 AND l_linenumber % 3 = 1 AND l_extendedprice <> 0 THEN ln(abs(l_extendedprice)) WHEN l_tax > 0 AND l_linenumber % 3 = 2 THEN l_extendedprice END, 8) AS loc,
  round(CASE WHEN l_tax > 0 AND l_linenumber % 3 = 1 AND l_extendedprice <> 0 THEN ln(sqrt(l_tax)) WHEN l_tax > 0 AND l_linenumber % 3 = 2 THEN l_tax / 2 END, 8) AS scale
FROM lineitem""")
def q_uncertainty(spark, d):
    li = t(spark, d, "lineitem")
    code, loc, scale = uncertainty(F.col("l_extendedprice"), (F.col("l_linenumber") % 3).cast("string"), F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", code.alias("uncertainty_type"), F.round(loc, 8).alias("loc"), F.round(scale, 8).alias("scale"))


@query(f"SELECT doc_id, {squash('text')} AS plain FROM documents WHERE text IS NOT NULL")
def q_strip_html(spark, d):
    marked = F.concat(F.lit("<p class='x'>"), F.col("text"), F.lit("<br/></p>"))
    return t(spark, d, "documents").where("text is not null").select("doc_id", text.strip_html(marked).alias("plain"))


@query(f"SELECT rec_id, nullif({strip(NOTE)}, '') AS definition FROM terms WHERE termScopeNote IS NOT NULL")
def q_scope_note(spark, d):
    return t(spark, d, "terms").where("termScopeNote is not null").select("rec_id", text.before(F.col("termScopeNote"), "£").alias("definition"))


@query("""
SELECT rec_id, CAST(row_number() OVER (PARTITION BY rec_id ORDER BY i, j) - 1 AS INT) AS at, trim(regexp_replace(seg, '^[^.]*\\.', '')) AS code FROM (
  SELECT rec_id, i, unnest(segs) AS seg, generate_subscripts(segs, 1) AS j FROM (
    SELECT rec_id, i, string_split(regexp_replace(spec, '^[^#]*#', ''), '$') AS segs FROM (
      SELECT rec_id, unnest(attrs['allFacets']) AS spec, generate_subscripts(attrs['allFacets'], 1) AS i FROM terms)))
WHERE contains(seg, '.') AND trim(regexp_replace(seg, '^[^.]*\\.', '')) <> ''""")
def q_facet_codes(spark, d):
    codes = F.flatten(F.transform(F.try_element_at("attrs", F.lit("allFacets")), arrays.facet_codes))
    return t(spark, d, "terms").select("rec_id", F.posexplode(codes).alias("at", "code"))


@query("""
WITH v AS (SELECT p_partkey, p_name, unnest([p_name, lower(p_name), p_brand, p_type, upper(p_type)]) AS v, unnest([1, 2, 3, 4, 5]) AS i FROM part),
f AS (SELECT p_partkey, p_name, lower(v) AS k, arg_min(v, i) AS v, min(i) AS i FROM v WHERE v <> '' GROUP BY ALL)
SELECT p_partkey, nullif(coalesce(string_agg(v, '|' ORDER BY i) FILTER (WHERE k <> lower(p_name)), ''), '') AS alt_labels FROM f GROUP BY p_partkey""")
def q_label_dedupe(spark, d):
    values = F.array(F.col("p_name"), F.lower("p_name"), F.col("p_brand"), F.col("p_type"), F.upper("p_type"))
    return t(spark, d, "part").select("p_partkey", F.array_join(arrays.alt_labels(F.col("p_name"), values), "|").alias("alt_labels"))


@query("SELECT rec_id, alt_labels[1] AS first_label FROM flows")
def q_first_element(spark, d):
    return t(spark, d, "flows").select("rec_id", arrays.first_element(F.col("alt_labels")).alias("first_label"))


@query(f"""
SELECT rec_id, nullif(CASE WHEN deleted_at IS NOT NULL THEN '[obsolete] ' ELSE '' END || substr({squash('comment')}, 1, 40), '') AS definition FROM processes""")
def q_truncate_definition(spark, d):
    return t(spark, d, "processes").select("rec_id", text.definition(F.col("comment"), F.col("deleted_at").isNotNull(), length=40).alias("definition"))


@query("""
SELECT rec_id, 'Category: ' || coalesce(process_type, '') || ' / ' || coalesce(location, '') || CASE WHEN deleted_at IS NOT NULL THEN '. withdrawn' ELSE '' END || '. Source: release' AS comment FROM processes""")
def q_comment(spark, d):
    return t(spark, d, "processes").select("rec_id", text.comment(F.col("process_type"), F.col("location"), F.col("deleted_at").isNotNull(), "withdrawn", "release").alias("comment"))


@query("""
SELECT c_custkey, nullif(concat_ws(' / ', nullif(r_name, ''), nullif(n_name, ''), nullif(c_mktsegment, '')), '') AS context
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_flow_context(spark, d):
    rows = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("c_custkey", text.path(F.col("r_name"), F.col("n_name"), F.col("c_mktsegment")).alias("context"))


_CATEGORY = "regexp_extract(comment, 'Category: ([^/.]*[^/. ]) /', 1)"
#: Sectors and their categories, written out for the check alone.
_SECTORS = """
01-agriculture: agricultural; food industry
02-electricity: electricity; electricity by fuel; photovoltaic; wind power; power plants; impoundment
03-chemicals: chemicals
04-transport: transport systems
05-energy: natural gas; heat; fuels; oil; heating; heat pumps; biomass; compressed air; pipeline; energy supply, kbob recommendation
06-waste: waste management; landfill; construction waste; electronics waste; wastewater treatment; waste; transport waste; incineration; nuclear waste; underground deposit; recycling; landfarming
07-construction: construction materials; construction; construction processes; building components; building processes; flooring; insulation materials; ceramics
08-materials: wood; metals; minerals; paper+ board; plastics; glass; textiles; cardboard
09-electronics: electronics; computers & network; mechanical
10-building-services: ventilation; water; private consumption; Others
99-obsolete: material, obsolete; energy, obsolete; processing, obsolete; waste treatment, obsolete
"""
_VALUES = ", ".join(f"('{c}', '{line.split(': ')[0]}')" for line in _SECTORS.strip().splitlines() for c in line.split(": ")[1].split("; "))


@query(f"""
WITH m(category, sector) AS (VALUES {_VALUES}), p AS (SELECT rec_id, {_CATEGORY} AS c FROM processes),
r AS (SELECT rec_id, coalesce(sector, '10-building-services') AS sector FROM p LEFT JOIN m ON category = c)
SELECT rec_id, sector, regexp_replace(sector, '^[^-]*-', '') AS slug FROM r
UNION ALL SELECT -row_number() OVER (ORDER BY category), sector, regexp_replace(sector, '^[^-]*-', '') FROM m""")
def q_route_sector(spark, d):
    """All processes, those without a known category as "Others", and every category of the map."""
    every = sorted(c for cs in routing.SECTORS.values() for c in cs)
    cat = F.regexp_extract("comment", "Category: ([^/.]*[^/. ]) /", 1)
    rows = t(spark, d, "processes").select("rec_id", F.when(cat.isin(every), cat).otherwise("Others").alias("category"))
    rows = rows.unionByName(spark.createDataFrame([(-i, c) for i, c in enumerate(every, 1)], "rec_id bigint, category string"))
    routed = rows.select("rec_id", routing.sector(F.col("category")).alias("sector"))
    return routed.withColumn("slug", routing.sector_slug(F.col("sector")))


@query("SELECT rec_id, CASE attrs['termType'][1] WHEN 'n' THEN 'organisms' WHEN 'f' THEN 'qualifiers' ELSE 'products' END AS category FROM terms")
def q_route_termtype(spark, d):
    return t(spark, d, "terms").select("rec_id", routing.term_category(F.try_element_at("attrs", F.lit("termType"))).alias("category"))


@query(f"SELECT rec_id, CASE upper({strip('status')}) WHEN 'APPROVED' THEN 'draft' WHEN 'PRELIMINARY' THEN 'draft' WHEN 'DEPRECATED' THEN 'deprecated' END AS status FROM terms")
def q_status(spark, d):
    return t(spark, d, "terms").select("rec_id", routing.status(F.col("status")).alias("status"))


@query("""
WITH c AS (SELECT rec_id, 'https://x.example/flow-contexts/' || CASE compartment WHEN 'air' THEN 'envi-air-' WHEN 'water' THEN 'envi-wate-' WHEN 'soil' THEN 'envi-grou-' ELSE 'reso-' END || coalesce(sub_compartment, '') || '/' AS iri, compartment FROM flows)
SELECT rec_id, CASE compartment WHEN 'air' THEN 'air' WHEN 'water' THEN 'water' WHEN 'soil' THEN 'soil' ELSE 'natural resource' END AS compartment FROM c""")
def q_context_path(spark, d):
    c = F.col("compartment")
    slug = F.when(c == "air", "envi-air-").when(c == "water", "envi-wate-").when(c == "soil", "envi-grou-").otherwise("reso-")
    iri = F.concat(F.lit("https://x.example/flow-contexts/"), slug, F.coalesce("sub_compartment", F.lit("")), F.lit("/"))
    return t(spark, d, "flows").select("rec_id", routing.context_compartment(iri).alias("compartment"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' AND l_linenumber - 1 = 0 THEN 'production' WHEN l_linenumber - 1 = 4 THEN 'biosphere' ELSE 'technosphere' END AS flow_type FROM lineitem""")
def q_flow_type(spark, d):
    group = F.when(F.col("l_returnflag") == "A", "output").otherwise("input")
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", routing.flow_type(group, F.col("l_linenumber") - 1).alias("flow_type"))


@query("SELECT rec_id, name FROM processes WHERE NOT (starts_with(coalesce(name, ''), 'xx') OR contains(coalesce(comment, ''), 'obsolete') OR contains(coalesce(technology, ''), 'notMaintained'))")
def q_obsolete_filter(spark, d):
    return t(spark, d, "processes").where(~routing.obsolete(F.col("name"), F.col("comment"), F.col("technology"))).select("rec_id", "name")


@query("SELECT rec_id FROM crosswalk WHERE coalesce(target_db IN ('ef', 'biosphere3'), FALSE) AND NOT contains(coalesce(tier, ''), '3') AND coalesce(tier, '') NOT IN ('T4')")
def q_shippable(spark, d):
    return t(spark, d, "crosswalk").where(routing.shippable(F.col("target_db"), F.col("tier"), ["ef", "biosphere3"], "3", ["T4"])).select("rec_id")


@query(f"SELECT rec_id, {denull('target_code')} AS target_code, {denull('source_cas')} AS source_cas FROM crosswalk")
def q_nullish_clean(spark, d):
    return t(spark, d, "crosswalk").select("rec_id", text.denulled(F.col("target_code")).alias("target_code"), text.denulled(F.col("source_cas")).alias("source_cas"))


@query("SELECT rec_id, unit_conversion AS factor FROM crosswalk WHERE unit_conversion IS NOT NULL AND unit_conversion <> 1.0")
def q_real_factor(spark, d):
    return t(spark, d, "crosswalk").select("rec_id", routing.real_factor(F.col("unit_conversion")).alias("factor")).where("factor is not null")


#: Reference units and their impact categories, written out for the check alone.
_IMPACTS = """
mol H+ eq: Acidification
kg CO2 eq: Climate change; Climate change-Biogenic; Climate change-Fossil; Climate change-Land use and land use change
disease incidence: EF-particulate Matter
kg N eq: Eutrophication marine
kg P eq: Eutrophication, freshwater
mol N eq: Eutrophication, terrestrial
CTUh: Human toxicity, cancer; Human toxicity, cancer_inorganics; Human toxicity, cancer_organics; Human toxicity, non-cancer; Human toxicity, non-cancer_inorganics; Human toxicity, non-cancer_organics
kBq U-235 eq: Ionising radiation, human health
Pt: Land use
kg CFC-11 eq: Ozone depletion
kg NMVOC eq: Photochemical ozone formation - human health
MJ: Resource use, fossils
kg Sb eq: Resource use, minerals and metals
m3 world eq deprived: Water use
CTUe: Ecotoxicity, freshwater; Ecotoxicity, freshwater_inorganics; Ecotoxicity, freshwater_organics
"""
_UNITS = ", ".join(f"('{k}', '{line.split(': ')[0]}')" for line in _IMPACTS.strip().splitlines() for k in line.split(": ")[1].split("; "))


@query(f"WITH m(k, u) AS (VALUES {_UNITS}, ('Noise', '')) SELECT k AS impact, u AS unit FROM m")
def q_reference_unit(spark, d):
    names = spark.createDataFrame([(k,) for k in [*routing.IMPACT_UNITS, "Noise"]], "impact string")
    return names.select("impact", routing.reference_unit(F.col("impact")).alias("unit"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def q_digest(spark, d):
    return t(spark, d, "documents").where("text is not null").select("doc_id", ids.digest(F.col("text")).alias("digest"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN extract('microsecond' FROM ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS iso FROM events")
def q_iso_timestamp(spark, d):
    return t(spark, d, "events").select("event_id", text.iso(F.col("ts")).alias("iso"))


@query("""
SELECT rec_id, nullif(concat_ws('|', CASE WHEN len(attrs['foodexOldCode']) > 0 THEN array_to_string(list_transform(attrs['foodexOldCode'], lambda x: 'foodex1:' || x), '|') END,
  CASE WHEN len(attrs['GEMSCode']) > 0 THEN array_to_string(list_transform(attrs['GEMSCode'], lambda x: 'gems:' || x), '|') END), '') AS notations FROM terms""")
def q_legacy_notations(spark, d):
    parts = [arrays.prefixed(F.try_element_at("attrs", F.lit(code)), prefix) for code, prefix in routing.LEGACY_CODES]
    return t(spark, d, "terms").select("rec_id", F.array_join(arrays.empty_to_null(arrays.dedupe(F.concat(*parts))), "|").alias("notations"))


@query("""
WITH x AS (SELECT rec_id, iri, unnest(related) AS r, generate_subscripts(related, 1) AS i FROM concepts),
e AS (SELECT * FROM x WHERE length(r) % 2 = 0),
m AS (SELECT rec_id, iri AS v, 0 AS i FROM e WHERE iri <> '' UNION ALL SELECT rec_id, r, i FROM e WHERE r <> '')
SELECT rec_id, string_agg(v, '|' ORDER BY i) AS matches FROM (SELECT rec_id, v, min(i) AS i FROM m GROUP BY ALL) GROUP BY rec_id""")
def q_exact_matches(spark, d):
    """Links of concepts as associations, those of even length as exact matches."""
    kind = lambda x: F.when(F.length(x) % 2 == 0, "xkos:exactMatch").otherwise("xkos:closeMatch")
    each = F.transform("related", lambda x: F.struct(kind(x).alias("type"), F.col("iri").alias("source"), x.alias("target")))
    rows = t(spark, d, "concepts").select("rec_id", arrays.exact_matches(each).alias("m")).where(F.size("m") > 0)
    return rows.select("rec_id", F.array_join("m", "|").alias("matches"))


@query(f"SELECT rec_id, CASE WHEN {strip('termCode')} <> '' AND parentCode IS NOT NULL THEN '{BASE}/c/' || termCode ELSE '{BASE}/l/' || {slug('termExtendedName')} END AS iri FROM terms")
def q_make_iri(spark, d):
    """Codes where the term has a parent, else the slug of its name."""
    code = F.when(text.nonblank(F.col("termCode")) & F.col("parentCode").isNotNull(), F.col("termCode"))
    return t(spark, d, "terms").select("rec_id", ids.code_or_slug_iri(ids.iri("c", code), F.col("termExtendedName"), "l").alias("iri"))


@query()
def q_mojibake(spark, d):
    """The simple repair of the audit (two encodings, three readings); no SQL expresses it."""
    return t(spark, d, "processes").where("name is not null").select("rec_id", text.repaired("name").alias("name"))


# --- joins -------------------------------------------------------------------------------------


@query("""
WITH i AS (SELECT process_id AS k, arg_max(name, (rec_id, name)) AS v FROM processes WHERE process_id IS NOT NULL GROUP BY 1)
SELECT rec_id, coalesce(i.v, flow) AS resolved FROM exchanges LEFT JOIN i ON flow = i.k WHERE flow_type = 'technosphere'""")
def q_resolve_numbers(spark, d):
    index = resolve.last_wins(t(spark, d, "processes"), "process_id", F.col("name"), "rec_id")
    rows = t(spark, d, "exchanges").where("flow_type = 'technosphere'").select("rec_id", "flow")
    return resolve.resolve(rows, "flow", index, "resolved").select("rec_id", "resolved")


_INDEX = """idx AS (SELECT termCode AS code, arg_max(CASE attrs['termType'][1] WHEN 'n' THEN 'organisms' WHEN 'f' THEN 'qualifiers' ELSE 'products' END, rec_id) AS category FROM terms WHERE termCode <> '' GROUP BY 1)"""


def terms(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "terms").withColumn("ord", F.col("rec_id"))


@query(f"WITH {_INDEX} SELECT rec_id, 'https://vocab.example/' || category || '/food/' || code AS broader FROM terms LEFT JOIN idx ON parentCode = code")
def q_broader_selfjoin(spark, d):
    rows = terms(spark, d)
    return resolve.broader(rows, resolve.code_index(rows), "food").select("rec_id", "broader")


@query(f"""
WITH {_INDEX},
segs AS (
  SELECT rec_id, termCode, k, i, string_split(regexp_replace(spec, '^[^#]*#', ''), '$') AS segs FROM (
    SELECT rec_id, termCode, 1 AS k, unnest(attrs['allFacets']) AS spec, generate_subscripts(attrs['allFacets'], 1) AS i FROM terms
    UNION ALL SELECT rec_id, termCode, 2, unnest(attrs['implicitFacets']), generate_subscripts(attrs['implicitFacets'], 1) FROM terms)),
codes AS (SELECT rec_id, termCode, k, i, generate_subscripts(segs, 1) AS j, unnest(segs) AS seg FROM segs),
links AS (SELECT rec_id, (k, i, j) AS pos, 'https://vocab.example/' || category || '/food/' || code AS iri FROM codes JOIN idx ON trim(regexp_replace(seg, '^[^.]*\\.', '')) = code WHERE contains(seg, '.') AND code IS DISTINCT FROM termCode),
firsts AS (SELECT rec_id, iri, min(pos) AS pos FROM links GROUP BY ALL)
SELECT rec_id, string_agg(iri, '|' ORDER BY pos) AS related FROM firsts GROUP BY rec_id""")
def q_related_links(spark, d):
    rows = terms(spark, d)
    found = resolve.related(rows, resolve.code_index(rows), "food")
    return found.select(F.col("ord").alias("rec_id"), F.array_join("related", "|").alias("related"))


@query("SELECT rec_id, iri FROM concepts c WHERE iri IS NULL OR NOT EXISTS (SELECT 1 FROM (SELECT unnest(related) AS r FROM concepts) WHERE r = c.iri)")
def q_anti_existing(spark, d):
    """Concepts that no other refers to."""
    c = t(spark, d, "concepts")
    return dedup.against(c.select("rec_id", "iri"), c.select(F.explode("related").alias("iri")), "skip")


@query("""
WITH k AS (SELECT DISTINCT o_custkey AS k FROM orders), hit AS (SELECT count(DISTINCT c_custkey) AS n FROM customer JOIN k ON c_custkey = k)
SELECT 'customers' AS rows_, n > 0 AS raised, least(n, 20) AS n_named FROM hit
UNION ALL SELECT 'numbers below zero', FALSE, 0""")
def q_semi_collisions(spark, d):
    """The policy ``error`` raises where an identifier exists and names up to 20; else the rows pass."""
    from quernstone.errors import DedupError

    orders = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    customers, out = t(spark, d, "customer").select("c_custkey"), []
    for what, rows in (("customers", customers), ("numbers below zero", customers.select((-F.col("c_custkey") - 1).alias("c_custkey")))):
        try:
            dedup.against(rows, orders, "error", "c_custkey")
            out.append((what, False, 0))
        except DedupError as e:
            out.append((what, True, len(str(e).split(": ")[1].split(", "))))
    return spark.createDataFrame(out, "rows_ string, raised boolean, n_named bigint")


@query("""
SELECT rec_id, iri, 'new' AS origin FROM concepts WHERE broader IS NOT NULL
UNION ALL SELECT rec_id, iri, 'old' FROM concepts c WHERE broader IS NULL AND (iri IS NULL OR NOT EXISTS (SELECT 1 FROM concepts n WHERE n.broader IS NOT NULL AND n.iri = c.iri))""")
def q_dedup_existing_overwrite(spark, d):
    """Incoming concepts (with a parent) stay whole; of the old ones those stay that none of them overwrites."""
    c = t(spark, d, "concepts").select("rec_id", "iri", "broader")
    new, old = c.where("broader is not null").select("rec_id", "iri"), c.where("broader is null").select("rec_id", "iri")
    kept = dedup.against(new, old, "overwrite").withColumn("origin", F.lit("new"))
    return kept.unionByName(dedup.against(old, new, "skip").withColumn("origin", F.lit("old")))


@query(f"""
WITH e AS (SELECT {fold(squash('pref_label'))} AS norm, min(iri) AS existing FROM flows WHERE iri IS NOT NULL AND pref_label IS NOT NULL GROUP BY 1)
SELECT f.iri, f.pref_label, existing FROM flows f JOIN e ON {fold(squash('f.pref_label'))} = norm WHERE f.iri <> existing""")
def q_label_cross_collision(spark, d):
    f = t(spark, d, "flows")
    return dedup.existing_collisions(f, f)


@query("""
SELECT 'process_id' AS "check", count(*) = 0 AS ok, CAST(count(*) AS VARCHAR) AS detail FROM exchanges x WHERE process_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM processes p WHERE p.process_id = x.process_id)
UNION ALL SELECT 'flow', count(*) = 0, CAST(count(*) AS VARCHAR) FROM exchanges x WHERE flow_type = 'biosphere' AND flow IS NOT NULL AND NOT EXISTS (SELECT 1 FROM flows f WHERE f.notation = x.flow)
UNION ALL SELECT 'input', count(*) = 0, CAST(count(*) AS VARCHAR) FROM exchanges x WHERE flow_type IN ('production', 'technosphere') AND flow IS NOT NULL AND NOT EXISTS (SELECT 1 FROM processes p WHERE p.process_id = x.flow)""")
def q_dangling_refs(spark, d):
    x, p, f = t(spark, d, "exchanges"), t(spark, d, "processes"), t(spark, d, "flows")
    bio = F.when(F.col("flow_type") == "biosphere", F.col("flow"))
    tech = F.when(F.col("flow_type").isin("production", "technosphere"), F.col("flow"))
    return checks.report(checks.refers(x, F.col("process_id"), p, "process_id", "process_id"), checks.refers(x, bio, f, "notation", "flow"), checks.refers(x, tech, p, "process_id", "input"))


@query(f"""
WITH k AS (SELECT DISTINCT {fold(squash('target_name'))} AS form FROM target_flows),
n AS (SELECT DISTINCT source_name FROM crosswalk WHERE source_name IS NOT NULL)
SELECT source_name FROM n WHERE {fold(squash('source_name'))} NOT IN (SELECT form FROM k) AND replace({fold(squash('source_name'))}, ' ', '-') NOT IN (SELECT form FROM k)
  AND regexp_replace({fold(squash('source_name'))}, ', technical grade$', '') NOT IN (SELECT form FROM k)""")
def q_coverage_alternatives(spark, d):
    known = t(spark, d, "target_flows").select(text.normalize_label(F.col("target_name")).alias("form"))
    n = text.normalize_label(F.col("n"))
    return checks.uncovered(t(spark, d, "crosswalk"), "source_name", known, "form", [n, F.replace(n, F.lit(" "), F.lit("-")), F.regexp_replace(n, ", technical grade$", "")])


# --- duplicates, aggregates, order -------------------------------------------------------------


@query("SELECT min(doc_id) AS doc_id, text FROM documents WHERE text IS NOT NULL GROUP BY text")
def q_dedup_intra(spark, d):
    docs = t(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return dedup.first_wins(docs, ["text"], "doc_id")


@query("""
SELECT process_id, count(DISTINCT (name, location)) AS n_variants FROM processes WHERE process_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT (name, location)) > 1""")
def q_dedup_conflicts(spark, d):
    return dedup.conflicts(t(spark, d, "processes").select("process_id", "name", "location", "rec_id"), "process_id", "rec_id")


@query(f"""
WITH r AS (SELECT iri, pref_label, rec_id, {fold(squash('pref_label'))} AS norm FROM flows WHERE iri IS NOT NULL AND pref_label IS NOT NULL),
f AS (SELECT norm, arg_min(iri, rec_id) AS first FROM r GROUP BY 1)
SELECT iri, pref_label, first FROM r JOIN f USING (norm) WHERE iri <> first""")
def q_label_collisions(spark, d):
    return dedup.label_collisions(t(spark, d, "flows"), order="rec_id")


@query("""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def q_first_wins_key(spark, d):
    li = t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return dedup.first_wins(li, ["l_partkey", "l_suppkey"]).drop("ord")


@query("SELECT event_type, min(event_id) AS event_id FROM events WHERE event_type <> '' GROUP BY 1")
def q_distinct_ordered(spark, d):
    return dedup.distinct_ordered(t(spark, d, "events"), "event_type", "event_id")


@query("SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_nationkey) AS items FROM nation GROUP BY 1")
def q_collect_ordered(spark, d):
    return dedup.collect_ordered(t(spark, d, "nation"), ["n_regionkey"], F.col("n_name"), "n_nationkey").withColumn("items", F.array_join("items", "|"))


@query("""
SELECT 'exchanges.rec_id' AS "check", count(*) = count(DISTINCT rec_id) AS ok, CAST(count(*) - count(DISTINCT rec_id) AS VARCHAR) AS detail FROM exchanges
UNION ALL SELECT 'regions', count(*) = 5, CAST(count(*) AS VARCHAR) FROM region""")
def q_uniqueness(spark, d):
    return checks.report(checks.unique(t(spark, d, "exchanges"), "rec_id", "exchanges.rec_id"), checks.row_count(t(spark, d, "region"), 5, "regions"))


_CHECKED = ["process_id", "flow", "flow_name", "amount", "unit", "uncertainty_type", "loc", "minimum"]


@query(" UNION ALL ".join(f"SELECT 'not null: {c}' AS \"check\", count(*) = count({c}) AS ok, CAST(count(*) - count({c}) AS VARCHAR) AS detail FROM exchanges" for c in _CHECKED))
def q_null_counts(spark, d):
    return checks.not_null(t(spark, d, "exchanges"), _CHECKED)


@query("""
SELECT 'direction' AS "check", count(*) FILTER (WHERE direction NOT IN ('input', 'output')) = 0 AS ok, CAST(count(*) FILTER (WHERE direction NOT IN ('input', 'output')) AS VARCHAR) AS detail FROM exchanges
UNION ALL SELECT 'status', count(*) FILTER (WHERE status NOT IN ('draft', 'published')) = 0, CAST(count(*) FILTER (WHERE status NOT IN ('draft', 'published')) AS VARCHAR) FROM concepts""")
def q_enum_check(spark, d):
    return checks.report(checks.in_domain(t(spark, d, "exchanges"), "direction", ["input", "output"], "direction"), checks.in_domain(t(spark, d, "concepts"), "status", ["draft", "published"], "status"))


@query(f"""
WITH r AS (SELECT c_custkey, c_name, c_mktsegment, r_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT DISTINCT '{BASE}/products/agribalyse/group/' || {slug('r_name')} AS iri, r_name AS pref_label, NULL AS notation, NULL AS broader, NULL AS alt_labels FROM r),
u AS (SELECT DISTINCT '{BASE}/products/agribalyse/subgroup/' || {slug('n_name')} AS iri, n_name AS pref_label, NULL AS notation, '{BASE}/products/agribalyse/group/' || {slug('r_name')} AS broader, NULL AS alt_labels FROM r)
SELECT * FROM g UNION ALL SELECT * FROM u
UNION ALL SELECT '{BASE}/products/agribalyse/' || c_custkey, c_name, CAST(c_custkey AS VARCHAR), '{BASE}/products/agribalyse/subgroup/' || {slug('n_name')}, CASE WHEN lower(c_mktsegment) <> lower(c_name) THEN c_mktsegment END FROM r""")
def q_union_hierarchy(spark, d):
    """Groups, subgroups and items of a product sheet, made of customers, nations and regions."""
    from quernstone.model import SourceConfig
    from quernstone.sources.families import Products

    c, n, r = (t(spark, d, x) for x in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    sheet = rows.select(F.col("c_custkey").cast("bigint").alias("ord"), F.col("c_custkey").cast("string").alias("agb"), F.lit("").alias("ciqual"), F.col("c_name").alias("name_fr"), F.col("c_mktsegment").alias("lci_name"), F.col("r_name").alias("group"), F.col("n_name").alias("subgroup"))
    out = Products(SourceConfig("x", "Products", "vocab", "products", "u", "parquet", "parquet")).transform(sheet)
    return out.select("iri", "pref_label", "notation", "broader", F.array_join("alt_labels", "|").alias("alt_labels"))


@query(f"""
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS k, p_name FROM part),
x AS (SELECT *, CASE WHEN l_returnflag = 'A' AND l_linenumber - 1 = 0 THEN 'production' WHEN l_linenumber - 1 = 4 THEN 'biosphere' ELSE 'technosphere' END AS flow_type FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS process_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'output' ELSE 'input' END, CAST(l_partkey AS VARCHAR), l_linestatus, l_returnflag, l_quantity) - 1 AS INT) AS at, flow_type, CASE WHEN l_returnflag = 'A' THEN 'output' ELSE 'input' END AS direction, l_quantity AS amount,
  CASE flow_type WHEN 'production' THEN CAST(l_orderkey AS VARCHAR) WHEN 'biosphere' THEN {uuid_sql("concat_ws('|', l_linestatus, l_returnflag, '')")} ELSE coalesce(p_name, CAST(l_partkey AS VARCHAR)) END AS flow
FROM x LEFT JOIN p ON flow_type = 'technosphere' AND CAST(l_partkey AS VARCHAR) = k""")
def q_exchange_explode(spark, d):
    """Exchange rows of datasets made of orders; parts are what inputs are resolved against."""
    li = t(spark, d, "lineitem")
    text_ = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    x = F.struct(
        F.col("l_linenumber").cast("int").alias("line"), F.when(F.col("l_returnflag") == "A", "output").otherwise("input").alias("group"), (F.col("l_linenumber") - 1).alias("group_code"), text_("l_partkey").alias("number"),
        F.col("l_linestatus").alias("name"), F.col("l_returnflag").alias("category"), none.alias("subcategory"), F.col("l_quantity").cast("double").alias("amount"), F.lit("kg").alias("unit"), none.alias("location"), none.alias("uncertainty_type"), F.lit(None).cast("double").alias("sd95"),
    )
    sets = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(x)).alias("exchanges")).select(F.col("l_orderkey").cast("bigint").alias("ord"), text_("l_orderkey").alias("uuid"), "exchanges")
    index = t(spark, d, "part").select(text_("p_partkey").alias("number"), F.col("p_name").alias("uuid"))
    rows = assemble.exchange_rows(sets, index)
    return rows.select("process_id", "at", "flow_type", "direction", "amount", "flow")


@query(f"""
SELECT rec_id, {strip('source_name')} AS s_name, nullif({strip('source_unit')}, '') AS s_unit, nullif(source_cas, '') AS s_cas, nullif(concat_ws('|', nullif(source_category, ''), nullif(source_subcategory, '')), '') AS s_context, {strip('target_name')} AS t_name, nullif(target_code, '') AS t_code,
  CASE WHEN unit_conversion <> 1.0 THEN unit_conversion END AS factor, coalesce(tier, '') || ' (priority tier ' || coalesce(CAST(candidate_count AS VARCHAR), 'None') || ')' AS comment
FROM crosswalk WHERE target_db IN ('ef', 'biosphere3') AND NOT contains(coalesce(tier, ''), '2') AND coalesce(tier, '') <> 'T4' AND {strip('source_name')} <> '' AND {strip('target_name')} <> ''""")
def q_curated_entries(spark, d):
    c = t(spark, d, "crosswalk").withColumn("provenance", F.col("tier")).withColumn("priority_tier", F.col("candidate_count")).withColumn("source_context", F.array("source_category", "source_subcategory"))
    e = assemble.curated_entries(c, ["ef", "biosphere3"], "2", ["T4"], keep=["rec_id"])
    return e.select("rec_id", F.col("source.name").alias("s_name"), F.col("source.unit").alias("s_unit"), F.col("source.cas_number").alias("s_cas"), F.array_join("source.context", "|").alias("s_context"), F.col("target.name").alias("t_name"), F.col("target.code").alias("t_code"), F.col("conversion_factor").alias("factor"), "comment")


@query("""
WITH x AS (SELECT *, 'http' || substr(iri, 5) AS i FROM concepts)
SELECT rec_id AS "row", 'slot ''pref_label'' is required' AS problem FROM x WHERE pref_label IS NULL
UNION ALL SELECT rec_id, 'slot ''iri'' is required' FROM x WHERE iri IS NULL
UNION ALL SELECT rec_id, 'slot ''status'' has the value ' || status FROM x WHERE status NOT IN ('draft', 'published')
UNION ALL SELECT rec_id, 'slot ''broader'' has the value ' || broader FROM x WHERE NOT regexp_full_match(broader, '[A-Za-z][A-Za-z0-9_+.-]*:[^ \t\n]*')
UNION ALL SELECT rec_id, 'slot ''notation'' is not allowed' FROM x WHERE notation IS NOT NULL
UNION ALL SELECT min(rec_id), 'slot ''iri'' repeats ' || iri FROM x WHERE iri IS NOT NULL GROUP BY iri HAVING count(*) > 1""")
def q_validate_rows(spark, d):
    """All violations of a closed class by the rows of concepts."""
    from quernstone.validate import schema

    rules = {"classes": {"Concept": {"attributes": {"iri": {"identifier": True, "required": True}, "pref_label": {"required": True}, "status": {"range": "Status"}, "broader": {"range": "uriorcurie"}, "alt_labels": {"multivalued": True}}}}, "slots": {}, "enums": {"Status": {"permissible_values": {"draft": {}, "published": {}}}}}
    rows = t(spark, d, "concepts").select(F.col("rec_id").alias("ord"), "iri", "pref_label", "status", "broader", "alt_labels", "notation")
    return schema.problems(rows, rules, "Concept")


@query(f"""
WITH b AS (SELECT flow_name, location, unit, rec_id, {uuid_sql("concat_ws('|', coalesce(flow_name, ''), coalesce(location, ''), coalesce(unit, ''))")} AS id FROM exchanges WHERE flow_type = 'biosphere'),
f AS (SELECT id, min(rec_id) AS rec_id FROM b GROUP BY 1)
SELECT '{BASE}/flows/' || id AS iri, flow_name AS pref_label, id AS notation, location AS compartment, unit AS sub_compartment FROM b JOIN f USING (id, rec_id)""")
def q_flow_terms(spark, d):
    """Terms of the distinct biosphere flows, every exchange being a dataset of one."""
    from quernstone.model import SourceConfig
    from quernstone.sources.families import LciFlowTerms

    x = F.struct(F.col("flow_name").alias("name"), F.col("location").alias("category"), F.col("unit").alias("subcategory"), F.lit("").alias("cas"), F.when(F.col("flow_type") == "biosphere", 4).otherwise(5).alias("group_code"))
    sets = t(spark, d, "exchanges").select(F.col("rec_id").alias("ord"), F.array(x).alias("exchanges"))
    terms_ = LciFlowTerms(SourceConfig("x", "LciFlowTerms", "vocab", "elementary-flows", "u", "zip", "parquet")).transform(sets)
    return terms_.select("iri", "pref_label", "notation", "compartment", "sub_compartment")


@query(f"""
SELECT {denull('source_name')} AS s_name, {uuid_sql("concat_ws('|', " + denull('source_name') + ", " + denull('source_category') + ", " + denull('source_subcategory') + ")")} AS s_code,
  nullif({denull('source_unit')}, '') AS s_unit, nullif(concat_ws('|', nullif({denull('source_category')}, ''), nullif({denull('source_subcategory')}, '')), '') AS s_context,
  nullif({denull('target_name')}, '') AS t_name, {denull('target_code')} AS t_code, nullif({denull('target_unit')}, '') AS t_unit,
  CASE WHEN len(target_categories) > 0 THEN array_to_string(list_filter(list_transform(target_categories, lambda x: {denull('x')}), lambda x: x <> ''), '|') END AS t_context,
  CASE WHEN unit_conversion <> 1.0 THEN unit_conversion END AS factor, CASE WHEN {denull('tier')} = 'T3' THEN 'broader' END AS comment
FROM crosswalk WHERE {denull('source_name')} <> '' AND {denull('target_code')} <> '' AND target_db = 'ef'""")
def q_package_entries(spark, d):
    e = assemble.crosswalk_entries(t(spark, d, "crosswalk"), notes={"T3": "broader"})
    return e.select(F.col("source.name").alias("s_name"), F.col("source.code").alias("s_code"), F.col("source.unit").alias("s_unit"), F.array_join("source.context", "|").alias("s_context"), F.col("target.name").alias("t_name"), F.col("target.code").alias("t_code"), F.col("target.unit").alias("t_unit"), F.array_join("target.context", "|").alias("t_context"), F.col("conversion_factor").alias("factor"), "comment")


@query("""
WITH p AS (SELECT event_id, unnest(json_keys(props)) AS name, props FROM events WHERE props IS NOT NULL),
k AS (SELECT event_id, name, json_type(props, '$.' || name) AS jt FROM p)
SELECT name, CASE max(CASE jt WHEN 'ARRAY' THEN 5 WHEN 'VARCHAR' THEN 4 WHEN 'OBJECT' THEN 4 WHEN 'DOUBLE' THEN 3 WHEN 'UBIGINT' THEN 2 WHEN 'BIGINT' THEN 2 WHEN 'BOOLEAN' THEN 1 ELSE 0 END)
  WHEN 5 THEN 'list' WHEN 4 THEN 'string' WHEN 3 THEN 'double' WHEN 2 THEN 'bigint' WHEN 1 THEN 'boolean' ELSE 'string' END AS kind, min(event_id) AS first_seen FROM k GROUP BY name""")
def q_schema_infer(spark, d):
    return infer.json_kinds(t(spark, d, "events"), "props", "event_id")


@query("SELECT rec_id, row_number() OVER (ORDER BY coalesce(nullif(notation, ''), nullif(iri, ''), ''), rec_id) AS row_no FROM concepts")
def q_stable_sort(spark, d):
    c = t(spark, d, "concepts")
    return shard.positions(c, [shard.sort_key(c), F.col("rec_id")]).select("rec_id", "row_no")


@query("SELECT rec_id, CAST((row_number() OVER (ORDER BY rec_id) - 1) // CAST(ceil((SELECT count(*) FROM flows) / 7) AS BIGINT) AS INT) + 1 AS shard FROM flows")
def q_shard(spark, d):
    return shard.shards(t(spark, d, "flows").select("rec_id"), [F.col("rec_id")], 7).select("rec_id", "shard")


@query(f"""
WITH c AS (SELECT iri, pref_label, status, rec_id FROM concepts WHERE iri IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY iri ORDER BY rec_id) AS rn FROM c),
v AS (SELECT iri, {squash('pref_label')} AS label, status FROM f WHERE rn = 1)
SELECT {uuid_sql("concat_ws('|', v.iri, v.label, '')")} AS id, v.iri, v.label, coalesce(v.status, 'none') AS status FROM v
WHERE v.label <> '' AND NOT EXISTS (SELECT 1 FROM flows WHERE flows.iri = v.iri)""")
def q_pipeline_flagship(spark, d):
    """Normalise, first-wins by identifier, drop what is published, mint ids."""
    c = t(spark, d, "concepts").where("iri is not null").select("iri", "pref_label", "status", "rec_id")
    first = dedup.first_wins(c, ["iri"], "rec_id")
    fresh = dedup.against(first, t(spark, d, "flows").select("iri"), "skip")
    out = fresh.select("iri", text.squash(F.col("pref_label")).alias("label"), F.coalesce("status", F.lit("none")).alias("status")).where("label != ''")
    return out.select(ids.flow_id(F.col("iri"), F.col("label"), F.lit("")).alias("id"), "iri", "label", "status")
