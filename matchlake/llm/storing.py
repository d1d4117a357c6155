"""Tables written to the folder all executors share, in place of lineage that a lost executor would have to redo."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from matchlake.session import checkpoint_dir


#: Lets Spark delete the shuffle files of a query once it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again. What it shuffled is deleted at once."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(spark))
    folder = f"{context.getCheckpointDir().rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once all that is made of them has itself been written."""
    for table in tables:
        jvm = table.sparkSession._jvm
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
