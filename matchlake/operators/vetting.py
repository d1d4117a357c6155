"""Vetting of a table of query texts: which of them only read?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.fixed_values import BLOCKED_WORDS
from matchlake.functions.plan import with_once


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")


def strip_fences(text: Column, language: str = "sql") -> Column:
    """The text inside a code fence (marked with the language or not), or the text itself."""
    bare = _bare(text)

    def inside(opening: str, closing: str) -> Column:
        return _bare(F.regexp_replace(F.regexp_replace(bare, "^" + opening, ""), closing + "$", ""))

    return (
        F.when(bare.startswith("```" + language), inside("```" + language, "```"))
        .when(bare.startswith("'''" + language), inside("'''" + language, "'''"))
        .when(bare.startswith("```"), inside("```", "```"))
        .otherwise(bare)
    )


def reason(query: Column) -> Column:
    """Why a query text is rejected; NULL where it is a single read-only statement without comments."""
    low = F.lower(query)
    blocked = "(^|[^a-z0-9_])(" + "|".join(BLOCKED_WORDS) + ")([^a-z0-9_]|$)"
    return (
        F.when(F.coalesce(low, F.lit("")) == "", "empty")
        .when(~low.rlike("^(select|with)([^a-z0-9_]|$)"), "not a query")
        .when(low.rlike(blocked), "blocked word")
        .when(F.contains(F.rtrim(low, F.lit(";")), F.lit(";")), "several statements")
        .when(
            F.contains(query, F.lit("--")) | F.contains(query, F.lit("/*")) | F.contains(query, F.lit("*/")), "comment"
        )
    )


def vet(df: DataFrame, text: str) -> DataFrame:
    """Add ``query`` (without fences), ``accepted`` and ``reason``."""
    bare = with_once(df, "query", strip_fences(F.col(text)))
    return with_once(bare, "reason", reason(F.col("query"))).withColumn("accepted", F.col("reason").isNull())
