"""SQL for the queries of :mod:`core_queries`; it runs in DuckDB over the same tables."""

from __future__ import annotations

# keys: case and surrounding white space do not count
_KEY = "CASE WHEN lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) NOT IN ('', 'nan', 'none', '<na>') THEN lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) END"


def _k(c: str) -> str:
    return _KEY.format(c=c)


_TREE = f"""
WITH RECURSIVE raw AS (
  SELECT 'terms' AS tab, {_k('termCode')} AS k, termCode AS written, {_k('parentCode')} AS up, loaded_at, rec_id FROM terms
  UNION ALL SELECT 'concepts', {_k('iri')}, iri, {_k('broader')}, loaded_at, rec_id FROM concepts),
node AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tab, k ORDER BY loaded_at DESC, rec_id DESC) AS rn FROM raw WHERE k IS NOT NULL) WHERE rn = 1),
edge AS (SELECT n.tab, n.k, n.written, p.k AS up FROM node n LEFT JOIN node p ON n.tab = p.tab AND n.up = p.k),
walk AS (
  SELECT tab, k, k AS cur, 0 AS steps, [k] AS trail, FALSE AS looped FROM edge
  UNION ALL
  SELECT w.tab, w.k, e.up, w.steps + 1, list_append(w.trail, e.up), list_contains(w.trail, e.up)
  FROM walk w JOIN edge e ON w.tab = e.tab AND w.cur = e.k WHERE e.up IS NOT NULL AND NOT w.looped),
fin AS (SELECT tab, k, arg_max(cur, steps) AS cur, max(steps) AS steps, arg_max(trail, steps) AS trail, bool_or(looped) AS looped FROM walk GROUP BY tab, k)
"""

SQL = {
    "p1_found": _TREE
    + """SELECT f.tab, e.written AS node,
  CASE WHEN f.looped THEN '(cycle)' ELSE r.written END AS root,
  CAST(CASE WHEN f.looped AND f.cur = f.k THEN -1 WHEN f.looped THEN -2 ELSE f.steps END AS INT) AS depth
FROM fin f JOIN edge e ON f.tab = e.tab AND f.k = e.k JOIN edge r ON f.tab = r.tab AND f.cur = r.k""",
    "p1_paths": _TREE
    + """SELECT tab, k AS node,
  CAST(CASE WHEN looped AND cur = k THEN -1 WHEN looped THEN -2 ELSE steps END AS INT) AS depth,
  array_to_string(list_reverse(CASE WHEN looped THEN trail[1:list_position(trail, cur)] ELSE trail END), ' > ') AS path FROM fin""",
    "p1_descendants": _TREE
    + """SELECT w.tab, w.cur AS ancestor, w.k AS descendant, CAST(w.steps AS INT) AS distance
FROM walk w WHERE w.steps > 0 AND NOT w.looped""",
}

_MISS = f"""
WITH par AS (
  SELECT 'processes' AS t, {_k('process_id')} AS k, rec_id, loaded_at, deleted_at FROM processes
  UNION ALL SELECT 'flows', {_k('notation')}, rec_id, loaded_at, deleted_at FROM flows
  UNION ALL SELECT 'concepts', {_k('iri')}, rec_id, loaded_at, deleted_at FROM concepts),
ref AS (
  SELECT 'exchanges' AS tab, rec_id, 'process_id' AS field, 'processes' AS t, process_id AS ref_key, {_k('process_id')} AS k, loaded_at FROM exchanges
  UNION ALL SELECT 'exchanges', rec_id, 'flow', CASE WHEN {_k('flow_type')} = 'biosphere' THEN 'flows' ELSE 'processes' END, flow, {_k('flow')}, loaded_at FROM exchanges WHERE {_k('flow_type')} IN ('production', 'technosphere', 'biosphere')
  UNION ALL SELECT 'concepts', rec_id, 'related', 'concepts', r, {_k('r')}, loaded_at FROM (SELECT DISTINCT rec_id, loaded_at, unnest(related) AS r FROM concepts)),
seen AS (
  SELECT r.tab, r.rec_id, r.field, r.ref_key, r.loaded_at, count(p.k) AS n,
    min(date_trunc('month', p.loaded_at)) AS first_month,
    arg_max(struct_pack(d := p.deleted_at), (p.loaded_at, p.rec_id)) FILTER (WHERE date_trunc('month', p.loaded_at) <= date_trunc('month', r.loaded_at)) AS last
  FROM ref r LEFT JOIN par p ON r.t = p.t AND r.k = p.k WHERE r.k IS NOT NULL GROUP BY ALL),
miss AS (
  SELECT *, CASE WHEN n = 0 THEN 'missing' WHEN first_month > date_trunc('month', loaded_at) THEN 'late' WHEN last.d <= loaded_at THEN 'deleted' END AS kind FROM seen)
"""
SQL["p2_found"] = _MISS + "SELECT tab, rec_id, field, ref_key, kind FROM miss WHERE kind IS NOT NULL"
SQL["p2_report"] = _MISS + "SELECT tab, field, kind, strftime(loaded_at, '%Y-%m') AS month, count(*) AS n_refs FROM miss WHERE kind IS NOT NULL GROUP BY ALL"

# Values by one pattern of alternatives; it leans on this data's values holding no delimiter unless they are quoted.
_VALUE = r"""'"(?:[^"]|"")*"|''F\d\d\.[^'']*''|F\d\d\.[^$|;,/\n\t"\[\]]+'"""
_REFS = r"""'https?://[^\s£|;,"Â]+|doc:[A-Za-z]{2}-\d+'"""
_GAPS = r"""'[\s£Â|;,"]+$'"""
_P3 = f"""
WITH f AS (
  SELECT rec_id, 'allFacets' AS field, unnest(attrs['allFacets']) AS s, generate_subscripts(attrs['allFacets'], 1) AS i FROM terms
  UNION ALL SELECT rec_id, 'implicitFacets', unnest(attrs['implicitFacets']), generate_subscripts(attrs['implicitFacets'], 1) FROM terms),
m AS (SELECT rec_id, field, i, regexp_extract_all(regexp_replace(s, '^\\s*[A-Za-z0-9]+\\s*#', ''), {_VALUE}) AS m FROM f),
v AS (SELECT rec_id, field, i, unnest(m) AS raw, generate_subscripts(m, 1) AS j FROM m),
n AS (SELECT rec_id, termScopeNote AS t, regexp_extract_all(termScopeNote, {_REFS}) AS refs FROM terms WHERE termScopeNote IS NOT NULL),
w AS (SELECT rec_id, refs, CASE WHEN len(refs) > 0 THEN substr(t, 1, strpos(t, refs[1]) - 1) ELSE t END AS t FROM n),
q AS (SELECT rec_id, refs, trim(CASE WHEN t[1] = '"' THEN replace(regexp_extract(t, '^"((?:[^"]|"")*)"', 1), '""', '"') ELSE regexp_replace(t, {_GAPS}, '') END) AS note FROM w),
every AS (
  SELECT rec_id, field, i, j, trim(CASE WHEN raw[1] = '"' THEN replace(raw[2:-2], '""', '"') WHEN raw[1] = '''' THEN raw[2:-2] ELSE raw END) AS value FROM v
  UNION ALL SELECT rec_id, 'termScopeNote', 0, 0, note FROM q WHERE note <> ''
  UNION ALL SELECT rec_id, 'termScopeNote', 1, generate_subscripts(refs, 1), unnest(refs) FROM q)"""
SQL["p3_found"] = _P3 + """,
numbered AS (SELECT rec_id, field, CAST(row_number() OVER (PARTITION BY rec_id, field ORDER BY i, j) AS INT) AS pos, value, count(*) OVER (PARTITION BY rec_id, field) AS k FROM every WHERE value <> '')
SELECT rec_id, field, pos, value FROM numbered WHERE k >= 2"""
# quotes that open a value and are never closed are what is left once all closed ones are taken out
SQL["p3_flags"] = _P3 + f""",
stray AS (SELECT field, sum(len(regexp_extract_all(regexp_replace(s, {_VALUE}, '', 'g'), '(?:^|[$|;,/\\s])["'']'))) AS n FROM f WHERE regexp_matches(s, 'F\\d\\d[.]') GROUP BY field)
SELECT field, count(*) AS n_values, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_flagged FROM every LEFT JOIN stray USING (field) WHERE value <> '' GROUP BY field"""


#: Spellings and what they mean, written out for the check alone: letters and digits only, in lower case.
_UNIT_FORMS = {
    "kg": "kg kgs kilogram kilogramm kilogramme kilograms", "g": "g gr gram gramm grams", "mg": "mg milligram milligramm milligrams", "ug": "ug mcg microgram",
    "t": "t to tonne tonnes metricton", "kt": "kt kilotonne kilotonnes", "lb": "lb lbs pound pounds",
    "MJ": "mj megajoule megajoules", "kJ": "kj kilojoule kilojoules", "GJ": "gj gigajoule", "TJ": "tj terajoule", "Wh": "wh watthour", "kWh": "kwh kilowatthour kilowattstunde", "MWh": "mwh megawatthour megawattstunde", "kcal": "kcal kilocalorie kilocalories",
    "m3": "m3 cbm cubicmeter cubicmetre kubikmeter metrecube", "l": "l dm3 liter litre litres ltr", "ml": "ml milliliter millilitre", "hl": "hl hectolitre hektoliter", "cm3": "cm3 ccm cubiccentimetre",
    "m": "m meter metre metres", "km": "km kilometer kilometre", "cm": "cm centimeter centimetre", "mi": "mi mile miles",
    "m2": "m2 quadratmeter sqm squaremeter squaremetre", "ha": "ha hectare hectares hektar", "km2": "km2 sqkm squarekilometre", "cm2": "cm2 sqcm squarecentimeter",
    "tkm": "tkm tonkm tonnekilometre tonnenkilometer", "kgkm": "kgkm", "kBq": "kbq kilobecquerel", "Bq": "bq becquerel", "MBq": "mbq megabecquerel",
    "m2a": "m2a m2year squaremetreyear", "haa": "haa hayear", "h": "h hr hrs hour hours stunde", "min": "min minute minuten minutes", "d": "d day days tag",
    "unit": "unit units p pcs pce piece item items stuck", "doz": "doz dozen dutzend",
}
_POWERS = {"hundred": 100, "hundert": 100, "thousand": 1000, "tausend": 1000, "tsd": 1000, "mille": 1000, "million": 1e6, "mio": 1e6, "billion": 1e9, "mrd": 1e9}


def _p4() -> tuple[str, str]:
    """Units by words alone, from a list of its own; the engine's way needs no words for most spellings."""
    words = ", ".join(f"('{w}', '{c}')" for c, ws in _UNIT_FORMS.items() for w in ws.split())
    powers = ", ".join(f"('{w}', {v:g})" for w, v in _POWERS.items())
    nothing = "('', 'nan', 'none', '<na>', 'n/a', 'na', 'n.a.', 'null', 'unknown')"
    said = lambda c: f"CASE WHEN lower(trim({c})) NOT IN {nothing} AND regexp_matches({c}, '\\pL') THEN {c} END"
    pattern = r"'(?:\[([^\[\]]{1,40})\]|\(((?:[^()]|\([^()]*\)){1,40})\)|(?:,\s+in|,\s+per|;\s*unit:|\samount in)\s+((?:[^,;\[\]()]|\([^()]*\)){1,40}))\s*$'"
    named = f"nullif(concat(regexp_extract(flow_name, {pattern}, 1), regexp_extract(flow_name, {pattern}, 2), regexp_extract(flow_name, {pattern}, 3)), '')"
    # the garblings of the few unit signs beyond ASCII
    signs = {"³": ["Â³", "┬│", "¬≥", "ÃÂ³", "Ã‚Â³", "Ві", "В³", "Âł"], "²": ["Â²", "┬▓", "¬≤", "Ã‚Â²", "ВІ", "В²", "Â˛"], "µ": ["Âµ", "┬╡", "Î¼", "╬╝", "Ã‚Âµ"], "ü": ["Ã¼", "├╝", "√º", "ÃƒÂ¼", "Гј", "ĂĽ"], "è": ["Ã¨", "├¿", "√®", "Г\xa0"]}
    fixed = "txt"
    for good, bads in signs.items():
        for bad in sorted(bads, key=len, reverse=True):
            fixed = f"replace({fixed}, '{bad}', '{good}')"
    vocabulary = f"""
WITH cc AS (SELECT unit_code AS code, unit_name AS name FROM units),
low AS (SELECT *, trim(regexp_replace({fixed}, '\\s+', ' ', 'g')) AS s FROM (SELECT DISTINCT txt FROM (
  SELECT coalesce({said('unit')}, {named}) AS txt FROM exchanges WHERE amount IS NOT NULL UNION ALL SELECT {said('source_unit')} FROM crosswalk UNION ALL SELECT {said('target_unit')} FROM crosswalk) WHERE txt IS NOT NULL)),
num AS (SELECT *,
  regexp_extract(s, '^10(?:\\^)?([⁰¹²³⁴⁵⁶⁷⁸⁹⁻]+|\\^-?[0-9]+) *(.+)$', 1) AS up, regexp_extract(s, '^([0-9]+(?:''[0-9]+)*(?:[.][0-9]+)?)(?:[eE](-?[0-9]+))? *([^0-9 ^⁰¹²³⁴⁵⁶⁷⁸⁹].*)$', 1) AS n,
  regexp_extract(s, '^([0-9]+(?:''[0-9]+)*(?:[.][0-9]+)?)(?:[eE](-?[0-9]+))? *([^0-9 ^⁰¹²³⁴⁵⁶⁷⁸⁹].*)$', 2) AS e, split_part(s, ' ', 1) AS head FROM low),
pw(w, v) AS (VALUES {powers}),
base AS (SELECT txt,
  CASE WHEN regexp_matches(s, '^10\\^-?[0-9]+ ') THEN pow(10, CAST(regexp_extract(s, '^10\\^(-?[0-9]+)', 1) AS INT)) WHEN regexp_matches(s, '^10[⁰¹²³⁴⁵⁶⁷⁸⁹⁻]+ ') THEN pow(10, CAST(translate(regexp_extract(s, '^10([⁰¹²³⁴⁵⁶⁷⁸⁹⁻]+)', 1), '⁰¹²³⁴⁵⁶⁷⁸⁹⁻', '0123456789-') AS INT))
    WHEN n <> '' THEN CAST(replace(n, '''', '') || CASE WHEN e <> '' THEN 'e' || e ELSE '' END AS DOUBLE) WHEN v IS NOT NULL THEN v ELSE 1.0 END AS mult,
  CASE WHEN regexp_matches(s, '^10\\^-?[0-9]+ |^10[⁰¹²³⁴⁵⁶⁷⁸⁹⁻]+ ') THEN regexp_replace(s, '^[^ ]+ ', '') WHEN n <> '' THEN regexp_replace(s, '^[0-9''.]+(?:[eE]-?[0-9]+)? *', '') WHEN v IS NOT NULL THEN substr(s, length(head) + 2) ELSE s END AS b
  FROM num LEFT JOIN pw ON lower(rtrim(head, '.')) = w AND s <> head),
form AS (SELECT *, regexp_replace(lower(strip_accents(translate(b, '²³µμ', '23uu'))), '[^a-z0-9]', '', 'g') AS f FROM base WHERE NOT regexp_matches(b, '[?�]')),
lex AS (SELECT * FROM (VALUES {words}) AS t(f, code)),
told AS (SELECT txt, mult, coalesce(x.code, CASE rtrim(trim(b), '.') WHEN 'Mg' THEN 't' WHEN 'Gg' THEN 'kt' END, lex.code, bare.code) AS code FROM (SELECT *, regexp_replace(lower(strip_accents(translate(regexp_replace(b, '\\(.*?\\)', ''), '²³µμ', '23uu'))), '[^a-z0-9]', '', 'g') AS g FROM form) form LEFT JOIN cc x ON trim(b) = x.code LEFT JOIN lex USING (f) LEFT JOIN lex bare ON bare.f = g)"""
    rows = f""",
voc AS (SELECT txt, mult, u.* FROM told JOIN units u ON code = u.unit_code),
ex AS (SELECT rec_id, amount, unit, coalesce({said('unit')}, {named}) AS txt FROM exchanges WHERE amount IS NOT NULL)
SELECT 'exchanges' AS tab, rec_id, common_unit AS unit, printf('%.4e', amount * mult * factor) AS value FROM ex JOIN voc USING (txt) WHERE unit IS DISTINCT FROM common_unit
UNION ALL
SELECT 'crosswalk', c.rec_id, b.unit_code, printf('%.4e', (a.mult * a.factor) / (b.mult * b.factor)) FROM crosswalk c JOIN voc a ON c.source_unit = a.txt JOIN voc b ON c.target_unit = b.txt
WHERE a.quantity = b.quantity AND (unit_conversion IS NULL OR abs(unit_conversion - (a.mult * a.factor) / (b.mult * b.factor)) > 0.01 * (a.mult * a.factor) / (b.mult * b.factor))"""
    return vocabulary + rows, vocabulary + " SELECT txt AS spelling, mult AS multiplier, code AS unit_code FROM told"


SQL["p4_found"], SQL["p4_units"] = _p4()
