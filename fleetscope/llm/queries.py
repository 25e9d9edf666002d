"""One registered query for each operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import (ann, decontaminate, langid, line_dedup, mixing, near_dup, pii, reshard, runs, token_counts,
                            toxicity, url_filter, variants)
from fleetscope.llm.common import held_out, read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_hits")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), 85, 100)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(url_filter.fetch_days(pages), url_filter.derived_log(pages))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op8_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard.shard_report(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = runs.collapse_runs(docs.select("doc_id", runs.repeated_words("doc_id", "text").alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("s"),
                                                              (-r["period"]).alias("p"), r["length"].alias("length"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), listed.alias("listed"), "text")
            .select("doc_id", "n_runs", (-F.col("b.s")).alias("start"), "b.length", (-F.col("b.p")).alias("period"),
                    F.expr("(1000 * b.length) div -b.p").alias("exponent_milli"),
                    F.sha2(F.array_join("listed", ""), 256).alias("runs_sha256"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.vocabulary(read_table(spark, sf_dir, "documents"), thin=199))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS bigint) AS n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *count, F.sha2(line(base), 256).alias("base_sha256"), line("spans").alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_toxicity, op3_token_counts, op4_near_duplicates, op5_nearest_neighbours,
    op6_url_filter, op7_language_id, op8_resharding, op9_decontamination, op10_source_mix,
    op11_periodic_runs, op12_spelling_variants, op13_personal_data)}
