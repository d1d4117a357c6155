"""Incremental staging: pick up the files that are new since the last run and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchlake.operators.maintain import dedupe
from matchlake.sources.documents import file_rows, split_documents


def stage_new_files(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Stage the unseen ``*.json`` files of ``folder`` under ``target``, one sub-folder per batch.

    A batch only ever writes its own sub-folder and writes it whole, so a batch that is repeated after a failure
    leaves the same result, and no run rewrites what earlier runs staged.
    """
    files = (
        spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.json").schema("value STRING")
        .format("text").load(folder)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_documents(batch)
        good.write.mode("overwrite").parquet(f"{target}/documents/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{target}/rejects/batch={batch_id}")

    return (
        file_rows(files).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
        .foreachBatch(write).start()
    )


def staged(spark: SparkSession, target: str) -> DataFrame:
    """The staged documents, each id in its latest form."""
    rows = spark.read.schema("id STRING, document STRING, batch BIGINT").parquet(f"{target}/documents")
    return dedupe(rows, ["id"], ["batch", "document"]).select("id", F.col("document"))
