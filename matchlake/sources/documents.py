"""Staging of match documents and their parsing into the typed document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.plan import with_once
from matchlake.operators.ranking import number_by_hash, null_safe_join
from matchlake.schemas import DOCUMENT
from matchlake.session import cut_lineage


def split_documents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of (id, document) whose text is JSON, and those whose text is not."""
    parsed = F.try_parse_json(F.col("document"))
    return raw.where(parsed.isNotNull()), raw.where(parsed.isNull())


def file_rows(df: DataFrame) -> DataFrame:
    """(id, document) from files read whole; the id is the file name without its ending."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    return df.select(stem.alias("id"), F.col("value").alias("document"))


def stage_documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All ``*.json`` files of a folder as (id, document): the readable ones and the malformed ones."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json")
    return split_documents(file_rows(files))


def _officials(officials: Column) -> Column:
    """Role to list of names, from values that are a list or one name."""
    return F.transform_values(
        officials,
        lambda _, v: F.coalesce(F.try_variant_get(v, "$", "array<string>"), F.array(F.try_variant_get(v, "$", "string"))),
    )


def parse_documents(staged: DataFrame) -> DataFrame:
    """(id, document) to (match_id, info, innings), typed; each text is parsed once."""
    text = staged.select(F.col("id").alias("match_id"), "document")
    doc = with_once(text, "doc", F.from_json("document", DOCUMENT))
    return doc.select(
        "match_id",
        F.col("doc.info").withField("officials", _officials(F.col("doc.info.officials"))).alias("info"),
        F.col("doc.innings").alias("innings"),
    )


def with_key_counts(docs: DataFrame) -> DataFrame:
    """Add how many innings, balls and dismissals each document has, whether or not they load."""
    def total(list_: Column, of: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.aggregate(list_, F.lit(0).cast("long"), lambda sum_, x: sum_ + of(x)), F.lit(0).cast("long"))

    def length(list_: Column) -> Column:
        return F.coalesce(F.greatest(F.size(list_), F.lit(0)).cast("long"), F.lit(0).cast("long"))

    innings = F.col("innings")
    return docs.withColumns({
        "n_innings": length(innings),
        "n_balls": total(innings, lambda i: total(i["overs"], lambda o: length(o["deliveries"]))),
        "n_wickets": total(innings, lambda i: total(i["overs"], lambda o: total(o["deliveries"], lambda d: length(d["wickets"])))),
    })


def number_matches(counted: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``match_id``, ``match_no`` and the key ranges of documents with their counts; known matches keep theirs.

    Only the counts are read, and they are written to the shared checkpoint folder first: they are needed several times, and
    ``counted`` may be long to read.
    """
    from matchlake.operators.maintain import KEY_RANGES, assign_key, assign_ranges

    counts = cut_lineage(counted.select("match_id", *KEY_RANGES))
    if existing is None:
        numbers = number_by_hash(counts.select("match_id"), ["match_id"], "match_no")
    else:
        numbers = assign_key(counts.select("match_id"), ["match_id"], "match_no", existing.select("match_id", "match_no"))
    return assign_ranges(null_safe_join(counts, numbers, ["match_id"]), existing)


def attach_numbers(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Documents with ``match_no`` and the key ranges of :func:`number_matches`."""
    own = numbers.select("match_id", "match_no", *[c for c in numbers.columns if c.startswith("before_")])
    return docs.drop("match_no").join(own, "match_id")
