"""Exact length histogram of encoded documents, and answers from its suffix sums.

The histogram has one row per encoded length.  Documents are encoded where they lie and
only (length, count) pairs are shuffled, so a source or text that holds a third of the
rows adds nothing.  Suffix sums run in two levels, over blocks of lengths and inside a
block, so no task sees all lengths.  Null and empty texts count as length 0; an empty
table gives an empty histogram.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import add_columns, documents
from tessera.session import stage

BLOCK = 1024


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def encoded_lengths(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``; special tokens in a text count as ordinary text."""

    def make():
        tokenizer = _tokenizer(path)
        return lambda texts: [(len(tokenizer.encode(t, add_special_tokens=False).ids) if t else 0,) for t in texts]

    return add_columns(docs, "n_tokens long", make, text)


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """Per distinct length: n_docs, docs_ge and tokens_ge (suffix sums, itself included),
    all documents and tokens, and truncated_tokens, what remains with this context limit."""
    counts = (
        lengths.groupBy(F.col(length).cast("long").alias("n_tokens"))
        .agg(F.count("*").alias("n_docs"))
        .withColumn("_tokens", F.col("n_tokens") * F.col("n_docs"))
        .withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    )
    counts = stage(counts, "length-counts")  # read twice: documents are encoded once
    blocks = counts.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    above = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = blocks.select(
        "_block",
        F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_da"),
        F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_ta"),
        F.sum("_d").over(everything).alias("all_docs"),
        F.sum("_t").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    suffix = counts.join(carried, "_block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("_da")).alias("docs_ge"),
        (F.sum("_tokens").over(inside) + F.col("_ta")).alias("tokens_ge"),
        "all_docs",
        "all_tokens",
    )
    return suffix.withColumn(
        "truncated_tokens", F.col("all_tokens") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")
    )


def quantiles(histogram: DataFrame, fractions: list[float]) -> DataFrame:
    """Smallest length that at least the given share of documents does not exceed."""
    rows = [F.struct(F.lit(q).alias("fraction"), F.ceil(F.lit(q) * F.col("all_docs")).alias("need")) for q in fractions]
    below = F.col("all_docs") - F.col("docs_ge") + F.col("n_docs")
    reached = histogram.withColumn("_q", F.explode(F.array(*rows))).where(below >= F.col("_q.need"))
    return reached.groupBy(F.col("_q.fraction").alias("fraction")).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens that remain when every document is cut at each limit."""
    kept = [
        F.struct(F.lit(x).alias("context"), F.least(F.col("n_tokens"), F.lit(x)).alias("kept")) for x in limits
    ]
    per_length = histogram.withColumn("_x", F.explode(F.array(*kept)))
    return per_length.groupBy(F.col("_x.context").alias("context")).agg(
        F.sum(F.col("_x.kept") * F.col("n_docs")).alias("tokens")
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return length_histogram(encoded_lengths(docs, public_tokenizers.path("byte_bpe_50k.json")))
