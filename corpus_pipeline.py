"""A training corpus from the table of documents, in five stages; each is written and read again.

Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ticketmill.llm import language_id, mixing, packing, quality_classifier, simhash, tokens
from ticketmill.llm.queries import labels
from ticketmill.llm.tables import documents, small_batches, stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language_id.in_known_language(docs)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality_classifier.of_good_quality(docs, labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.one_of_each_group(docs, shingle_words=4, distance=4)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mix_sources(docs).select(docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    special = tokens.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), window=1024, special=special)


STAGES = [
    ("language_id", keep_known_languages),
    ("quality_classifier", keep_good_quality),
    ("simhash_dedup", drop_near_duplicates),
    ("poisson_mix", mix_to_weights),
    ("retrieval_packing", pack_windows),
]

#: The first stages are trained classifiers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
