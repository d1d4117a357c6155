"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from matchlake.llm import (
    chat, embedding_dedup, main_text, mixing, packing, ppm, prefix_join, prefix_trie, quality, secrets, suffix_buckets, toxicity, whitening,
)
from matchlake.llm.check_sql import CHECK_SQL

__all__ = ["CHECK_SQL", "QUERIES"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """What crc32 of a doc_id as text leaves of ``divisor``; a NULL doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document; labels of a fifth are held out from learning."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(toxicity.labelled_sample(docs, table(spark, folder, "labels"), remainder(5) != 0))
    return toxicity.score(docs, model).select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    tricky = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text",
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    return chat.digest(chat.format_conversations(turns))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """A mixture of all documents, as large as the corpus, with each source weighted by the root of its size."""
    return mixing.mix(table(spark, folder, "documents"))


def op4_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and distance from its language's references of every document."""
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.references(docs))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find(docs, secrets.learn(docs)))


def op6_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents that share three quarters of their five-word shingles."""
    return prefix_join.near_duplicates(table(spark, folder, "documents"))


def op7_sign_hash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of vectors with a cosine of 0.98 or more within a label."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op8_text_density(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, folder, "pages"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into bins; a bin never holds two texts of the same words."""
    return packing.pack(table(spark, folder, "documents"))


def op10_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document by code length; a quarter of them is held out from learning."""
    docs, held_out = table(spark, folder, "documents"), remainder(4) == 2
    return ppm.identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_suffix_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages of 400 bytes that occur twice."""
    return suffix_buckets.remove_repeats(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Eight whitened components of every vector."""
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """What the rebuilt conversations share, node by node."""
    return prefix_trie.trie(prefix_trie.spliced(prefix_trie.paths(table(spark, folder, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_toxicity, op2_chat_format, op3_source_mix, op4_quality_divergence, op5_secret_scan, op6_prefix_join, op7_sign_hash_dedup,
        op8_text_density, op9_best_fit_packing, op10_ppm_language, op11_suffix_buckets, op12_whitening,
        op13_prefix_trie,
    )
} | {"pipeline": corpus_pipeline.run}
