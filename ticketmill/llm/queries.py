"""The registered queries of the operators: functions of (spark, folder of the tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import (
    class_lm, fingerprints, infill, language_id, mixing, packing, preferences, quality_classifier, rule_cascade, search,
    simhash, substring, tokens, toxicity,
)
from ticketmill.llm.tables import documents


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.predict_quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    special = tokens.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(documents(spark, sf_dir), vocabulary, window=1024, special=special)


def op4_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.judge_documents(documents(spark, sf_dir))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(documents(spark, sf_dir))


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    made = preferences.format_preferences(preferences.replies_of_others(turns))
    spans = {f"{side}_spans": _spans(f"{side}_spans") for side in ("chosen", "rejected")}
    return made.withColumns(spans)


def _spans(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(documents(spark, sf_dir), shingle_words=4, distance=4)
    return groups.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search.search(documents(spark, sf_dir), items, k=20)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.drop_repeated(documents(spark, sf_dir), window=13)
    sizes = F.transform("removed", lambda s: s["stop"] - s["start"])
    n_removed = F.aggregate(sizes, F.lit(0).cast("long"), lambda total, size: total + size)
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infill(documents(spark, sf_dir))
    restored = infill.restore("output", "form")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_quality_classifier, op3_retrieval_packing, op4_rule_cascade, op5_poisson_mix,
        op6_language_id, op7_preferences, op8_toxicity, op9_simhash, op10_class_lm,
        op11_ranked_search, op12_substring_dedup, op13_infill,
    )
}
