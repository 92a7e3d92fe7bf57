"""Pipeline from raw documents to encoded training text.

Each stage works on all rows its predecessor kept; ``run`` writes every stage as Parquet
into the shared folder and rereads it, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, language_id, near_dedup, pii
from tessera.llm.common import fold
from tessera.session import stage

#: Below this calibrated probability of the best language a document is rejected.
MIN_LANGUAGE_SCORE = 0.4
#: Documents of this word-shingle similarity in percent, or more, are near duplicates.
NEAR_DUPLICATE = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those no language is probable for.

    Where no document has a language to learn from, nothing can be judged and only
    documents without a letter are dropped.
    """
    model = language_id.train(docs.where(~fold("doc_id", 1, 3)))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs, model)
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group."""
    dropped = near_dedup.near_duplicates(docs, threshold=NEAR_DUPLICATE).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, benchmark).select(docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates and set n_chars to the new length."""
    replaced = pii.surrogates(docs)
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the text decoded from them."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("pii", replace_personal_data),
    ("bpe", encode),
]

#: Hashing, models and byte pairs are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
