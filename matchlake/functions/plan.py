"""Keeping expensive expressions from being computed more than once, or in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn(name, value)``, with ``value`` computed once per row.

    The optimizer copies a column's expression into every later filter on it and into their columns, which repeats a
    JSON parse or a long array expression many times over. A one-element explode ends that.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode_outer(F.array(value)).alias(name))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Distribute rows by ``key`` over the session's shuffle partitions, for long per-row work on compact files."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
