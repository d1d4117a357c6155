"""The corpus pipeline: toxic documents and near duplicates go, secrets are blacked out, sources are mixed, bins are packed.

Each stage takes (spark, docs, folder of the tables) and works on all rows its predecessor kept; between stages the rows are
written as Parquet below ``spark.checkpoint.dir`` and read again. No stage but the last changes the columns of documents, and
further columns may have any name. Every stage gives no rows for no rows, takes NULL texts for empty ones and whole texts of any length.
SQL cannot express the classifier or the packing, so tests compare the pipeline with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import mixing, packing, prefix_join, secrets, toxicity
from matchlake.llm.columns import set_aside
from matchlake.llm.storing import stored

#: SQL cannot express every stage.
ORACLE_SQL = None
#: The row key's column while a stage works.
KEY = "row_key_of_stage"


def _may_learn():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0


def _values(docs: DataFrame) -> list:
    """All columns of a row as text, and which of them are NULL."""
    return [F.col(f"`{c}`").cast("string") for c in docs.columns] + [F.col(f"`{c}`").isNull() for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; labels of the held-out fifth are not learned from.

    A NULL or empty text has the score of no words. Of repeated rows all stay or all go.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    plain, given = set_aside(docs, ("doc_id", "text"))
    model = toxicity.fit(toxicity.labelled_sample(plain, labels, _may_learn()))
    scored = toxicity.score(plain, model, *plain.columns)
    return scored.where("predicted = 0").select(*given)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id (NULL last), then of the smallest row key.

    Rows are told apart by a hash of all their columns, so rows that share a doc_id, or have none, are documents of their own. Equal
    rows are one; texts without words are near duplicates of nothing else.
    """
    plain, given = set_aside(docs, ("doc_id", "text"))
    keyed = plain.withColumn(KEY, F.xxhash64(*_values(plain)))
    component = prefix_join.near_duplicates(keyed.select(F.col(KEY).alias("doc_id"), "text")).distinct().select(
        F.col("doc_id").alias(KEY), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)
    first = keyed.select("doc_id", KEY).join(component, KEY).groupBy("component_id").agg(F.min(order).alias("first"))
    kept = keyed.join(first.select(F.col("first")[KEY].alias(KEY)), KEY, "left_semi")
    return kept.dropDuplicates([KEY]).select(*given)


def black_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by a mark and ``n_chars`` counted anew. NULL texts stay NULL."""
    plain, given = set_aside(docs, ("doc_id", "text", "n_chars"))
    return secrets.redact(secrets.find(plain, secrets.learn(plain))).select(*given)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by source; a document drawn n times stands in n rows. A NULL source is a source."""
    plain, given = set_aside(docs, ("doc_id", "text", "source"))
    return mixing.mix(plain).select(*given)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing of the mixture: one row per piece. A NULL or empty text is a piece without characters; repeated rows are numbered."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("secrets", black_out_secrets), ("mixing", mix_sources),
    ("packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
