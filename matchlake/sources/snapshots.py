"""Writing tables: full rebuilds, stamped copies and their return."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace the table at ``path``; its reader must not be part of ``df``."""
    writer = df.write.mode("overwrite")
    columns = list(partition_by)
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written at ``path`` and read back. Unlike a checkpoint the table has a size that the planner knows."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_ball_fact(balls: DataFrame, path: str) -> None:
    """The ball fact by season, so that a season's question reads one season.

    Rows are spread over (season, hash of the match), which keeps files of one season together without sending a
    whole season through one task.
    """
    spread = balls.repartition("season_year", "match_id").sortWithinPartitions("season_year", "match_id")
    write_table(spread, path, ["season_year"])


def rebuild(tables: dict[str, DataFrame], folder: str, keep: Iterable[str] = ("players",)) -> list[str]:
    """Write every derived table anew, leaving the curated ones alone; returns the names written."""
    kept = set(keep)
    written = [name for name in tables if name not in kept]
    for name in written:
        write_table(tables[name], f"{folder}/{name}")
    return written


def snapshot(df: DataFrame, folder: str, name: str, stamp: str | None = None) -> str:
    """A stamped copy of one table; fails rather than replace an earlier copy. Returns its path."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = f"{folder}/{name}_{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def restore(spark: SparkSession, path: str, target: str | None = None) -> DataFrame:
    """The copy at ``path``; with ``target``, that table is replaced by it."""
    copy = spark.read.parquet(path)
    if target is None:
        return copy
    write_table(copy, target)
    return spark.read.parquet(target)
