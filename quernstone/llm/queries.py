"""The queries of the problems tagged llm (p5 to p9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.keys import stripped
from quernstone.llm import abuse, clusters, linkage, mixing, mojibake, packing, tokens
from quernstone.session import cut


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    ex = table(spark, d, "exchanges").select(F.lit("exchanges").alias("tab"), "rec_id", F.col("flow_name").alias("text"))
    pr = table(spark, d, "processes").select(F.lit("processes").alias("tab"), "rec_id", F.col("name").alias("text"))
    return mojibake.restored(ex.unionByName(pr))


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    cw = table(spark, d, "crosswalk").select(F.col("rec_id").alias("id"), F.col("source_name").alias("name"), F.col("source_category").alias("category"), F.col("source_subcategory").alias("sub"), F.col("source_cas").alias("cas"), F.col("target_code").alias("linked"))
    tf = table(spark, d, "target_flows").select(F.col("target_id").alias("id"), F.col("target_code").alias("code"), F.col("target_name").alias("name"), F.col("target_synonyms").alias("synonyms"), F.col("target_cas").alias("cas"), F.col("target_categories").alias("categories"))
    return linkage.match(cw, tf).withColumnRenamed("id", "rec_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_matches(spark, d).select("rec_id", "target_id")


def p6_exact(spark: SparkSession, d: str) -> DataFrame:
    """The matches whose names are equal but for case, at places that links tell."""
    cw, tf = table(spark, d, "crosswalk"), table(spark, d, "target_flows")
    same = lambda c: F.lower(stripped(F.col(c)))
    links = cw.select("source_category", "source_subcategory", same("target_code").alias("code")).join(tf.select(same("target_code").alias("code"), "target_categories"), "code")
    told = links.select(F.col("source_category").alias("c"), F.col("source_subcategory").alias("s"), F.col("target_categories").alias("p")).distinct()
    rows = p6_found(spark, d).join(cw.select("rec_id", "source_name", "source_category", "source_subcategory"), "rec_id").join(tf.select("target_id", "target_name", "target_categories"), "target_id")
    rows = rows.join(told, F.col("source_category").eqNullSafe(F.col("c")) & F.col("source_subcategory").eqNullSafe(F.col("s")) & (F.col("target_categories") == F.col("p")))
    return rows.where(same("source_name") == same("target_name")).select("rec_id", "target_id")


def p7_sized(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, lang, source, cluster, n_tokens): one pass over the texts for tokens and signatures."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    more = lambda texts: dict(zip(("digest", "bands"), clusters.signed(texts), strict=True))
    sized = cut(tokens.counted(docs, ["doc_id", "lang", "source"], more=more, more_schema="digest bigint, bands array<bigint>"))
    return cut(clusters.clustered(sized, docs))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(p7_sized(spark, d), table(spark, d, "pack_specs"))


def p7_fills(spark: SparkSession, d: str) -> DataFrame:
    return packing.fills(p7_containers(spark, d))


def p7_summary(spark: SparkSession, d: str) -> DataFrame:
    sized = p7_sized(spark, d)
    return packing.summary(packing.containers(sized, table(spark, d, "pack_specs")), sized)


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """Texts placed per spec, and what must not happen: containers over their capacity, texts cut that would fit, pieces lost."""
    placed = cut(p7_containers(spark, d))
    over = placed.groupBy("spec_id", "container").agg((F.sum("tokens") > F.first("capacity")).cast("int").alias("over")).groupBy("spec_id").agg(F.sum("over").alias("n_over_full"))
    docs = placed.groupBy("spec_id", "doc_id").agg(F.count("*").alias("k"), F.max("n_pieces").alias("n_pieces"), F.sum("tokens").alias("tokens"), F.max("capacity").alias("capacity"))
    bad = docs.groupBy("spec_id").agg(F.count("*").alias("n_docs"), F.count_if((F.col("k") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("n_cut_without_need"), F.count_if(F.col("k") != F.col("n_pieces")).alias("n_lost_pieces"))
    return bad.join(over, "spec_id").select("spec_id", "n_docs", "n_over_full", "n_cut_without_need", "n_lost_pieces")


#: Domains of the sources: what is published about records, and what people write about them.
DOMAINS = {s: "records" for s in ("process_comments", "scope_notes", "method_sheets", "import_reports", "glossary")} | {s: "people" for s in ("review_threads", "user_feedback", "forum_archive", "field_diaries")}


def p8_sized(spark: SparkSession, d: str) -> DataFrame:
    return cut(tokens.counted(table(spark, d, "documents"), ["doc_id", "source", "lang"]))


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(p8_sized(spark, d), table(spark, d, "mix_targets"), domains=DOMAINS)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(cut(p8_mixed(spark, d)), table(spark, d, "mix_targets"))


def p8_checked(spark: SparkSession, d: str) -> DataFrame:
    """Per mix and source with documents: no document too often, the share within half a percent of the target."""
    s = p8_shares(spark, d).where("n_docs > 0")
    near = F.abs(F.col("actual_share") - F.col("target_share")) <= 0.005
    return s.select("mix_id", "source", (F.col("most_used") <= F.col("max_repeats")).alias("in_limit"), near.alias("on_target"))


def p8_mixed_full(spark: SparkSession, d: str) -> DataFrame:
    """The selection for mixes of as many tokens as there are in all documents: small sources run short."""
    sized = p8_sized(spark, d)
    n = sized.agg(F.sum("n_tokens")).first()[0] or 0
    return mixing.mixed(sized, table(spark, d, "mix_targets"), total_tokens=n, domains=DOMAINS)


def p8_shares_full(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(cut(p8_mixed_full(spark, d)), table(spark, d, "mix_targets"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return abuse.scored(docs, abuse.fitted(docs, table(spark, d, "abuse_labels")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where(F.col("score") >= abuse.THRESHOLD).select("doc_id")


def p9_counted(spark: SparkSession, d: str) -> DataFrame:
    """Per source: texts scored, blank ones among them, and blank ones that were called."""
    s = p9_scores(spark, d).join(table(spark, d, "documents").select("doc_id", F.col("text").isNull().alias("none"), (F.trim("text") == "").alias("empty")), "doc_id")
    blank = F.col("none") | F.coalesce("empty", F.lit(False))
    return s.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(blank).alias("n_blank"), F.count_if(blank & (F.col("score") >= abuse.THRESHOLD)).alias("n_blank_called"))


def p9_held_out(spark: SparkSession, d: str) -> DataFrame:
    """Recall and precision on the labels that were not learned from."""
    return abuse.held_out(table(spark, d, "documents"), table(spark, d, "abuse_labels"), p9_scores(spark, d))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p9_scores(spark, d))


QUERIES = {
    f.__name__: f
    for f in (p5_found, p6_found, p6_matches, p6_exact, p7_containers, p7_fills, p7_summary, p7_checked, p8_mixed, p8_mixed_full, p8_shares, p8_shares_full, p8_checked, p9_found, p9_scores, p9_rates, p9_counted, p9_held_out)
}
