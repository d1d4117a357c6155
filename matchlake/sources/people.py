"""The people file and the players table made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.fixed_values import PLAYER_ATTRIBUTES
from matchlake.operators.maintain import dedupe, upsert


def clean_people(rows: DataFrame) -> DataFrame:
    """Empty text becomes NULL, rows without an identifier are left out."""
    cleaned = rows.select(
        *[F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
          for f in rows.schema.fields]
    )
    return cleaned.where(F.col("identifier").isNotNull())


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """A header-driven CSV file; every column is text, whatever columns there are. The last row of an identifier counts."""
    lines = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    # A file with quoted line breaks is read as one piece, so the running number follows its lines.
    placed = clean_people(lines.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line")))
    return dedupe(placed, ["identifier"], ["_file", "_line"]).drop("_file", "_line")


def new_players(people: DataFrame) -> DataFrame:
    """Players as the people file knows them: names and one provider key, attributes still open."""
    blank = [
        F.lit(None).cast("date" if c == "date_of_birth" else "string").alias(c)
        for c in [*PLAYER_ATTRIBUTES, "first_last_name"]
    ]
    return people.select("identifier", "name", "unique_name", "key_cricinfo", *blank)


def load_players(people: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """Add people that are not players yet; existing players, with their enrichment, stay as they are.

    A player stands for all rows of an identifier; the largest names count where they differ (``read_people`` leaves one row).
    """
    new = dedupe(new_players(people), ["identifier"], ["name", "unique_name", "key_cricinfo"])
    return new if players is None else upsert(players, new, ["identifier"], "ignore")
