"""Column expressions for the match header."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(text: Column) -> Column:
    """The first four characters as a year; NULL where they are no number or zero."""
    return F.nullif(F.substring(text, 1, 4).try_cast("int"), F.lit(0))


def season_col(season: Column, dates: Column) -> Column:
    """Season year from the season text ("2023", "2007/08"), else from the first date."""
    return F.coalesce(year_of(season), year_of(F.get(dates, F.lit(0))))


def outcome_cols(outcome: Column) -> tuple[Column, Column]:
    """Kind and margin of the result: wickets before runs; a result text has no margin."""
    wickets, runs = outcome["by"]["wickets"], outcome["by"]["runs"]
    kind = (
        F.when(wickets.isNotNull(), "wickets")
        .when(runs.isNotNull(), "runs")
        .when(outcome["by"].isNull(), outcome["result"])
    )
    return kind, F.coalesce(wickets, runs)


def present(name: Column) -> Column:
    """A name that is there and not empty."""
    return F.coalesce(name, F.lit("")) != ""
