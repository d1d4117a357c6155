"""Positions, ranks, running totals and quantiles that no single task has to see whole.

A plain ``Window`` sorts every row of a group in one task, and a window without a partition sorts everything in
one. Here the order is cut into buckets that follow it: each bucket is summed up first (with map-side combine), the
few bucket totals are accumulated, and the rows only need their place inside their own bucket. The results are the
same as those of the plain window, for any distribution of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.numbers import hash_bucket, magnitude_bucket, whole_div
from matchlake.session import cut_lineage

_BEFORE = (Window.unboundedPreceding, -1)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the key columns of ``left`` are kept."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], amounts: dict[str, Column]
) -> DataFrame:
    """Add a column per entry of ``amounts``: its sum over the rows of the same ``keys`` that come before this one.

    The order is (bucket, *order); ``bucket`` must never decrease along ``order`` where both are given by the caller's
    wish, and ``order`` must be total inside one bucket. ``df`` is read twice however many amounts there are.
    """
    keys = list(keys)
    cut = df.withColumn("_bucket", bucket).withColumns({f"_amount_{out}": amount for out, amount in amounts.items()})
    totals = cut.groupBy(*keys, "_bucket").agg(*[F.sum(f"_amount_{out}").alias(f"_bucket_{out}") for out in amounts])
    # One row per bucket: with no keys this window has no partition, but then its input is the list of buckets.
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(*_BEFORE)
    starts = totals.select(
        *keys, "_bucket", *[F.coalesce(F.sum(f"_bucket_{out}").over(across), F.lit(0)).alias(f"_start_{out}") for out in amounts]
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(*_BEFORE)
    placed = null_safe_join(cut, starts, [*keys, "_bucket"])
    sums = {out: F.col(f"_start_{out}") + F.coalesce(F.sum(f"_amount_{out}").over(inside), F.lit(0)) for out in amounts}
    return placed.withColumns(sums).drop("_bucket", *[f"{kind}_{out}" for out in amounts for kind in ("_amount", "_start")])


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], amount: Column, out: str
) -> DataFrame:
    """As :func:`running_totals`, for one amount."""
    return running_totals(df, keys, bucket, order, {out: amount})


def number_rows(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], out: str) -> DataFrame:
    """Add ``out``: 1, 2, 3, ... within ``keys`` by (bucket, *order)."""
    numbered = running_total(df, keys, bucket, order, F.lit(1).cast("long"), out)
    return numbered.withColumn(out, F.col(out) + 1)


def number_by_hash(df: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: a dense number from 1 for rows that are unique on ``key``, in hash order of the key."""
    columns = [F.col(k) for k in key]
    return number_rows(df, [], hash_bucket(*columns), columns, out)


def rank_by(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    """Add ``out``: the ``rank()`` of a numeric column over all rows, ties sharing the lowest position."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    sign = F.lit(-1.0 if descending else 1.0)
    order = F.col(value).cast("double") * sign
    ranked = running_total(counts, [], magnitude_bucket(order), [order], F.col("_n"), out)
    return null_safe_join(df, ranked.select(value, (F.col(out) + 1).alias(out)), [value])


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str = "n") -> DataFrame:
    """One row per distinct value and key with its number of rows; the base of the distribution shapes.

    NULL and NaN are no values.
    """
    given = F.col(value).isNotNull()
    if df.schema[value].dataType.typeName() in ("float", "double"):
        given = given & ~F.isnan(value)
    return df.where(given).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(weight))


def counted(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows of ``value_counts``, dealt by ranges of (keys, value) and written to the shared checkpoint folder.

    The splitters come from a sample of the counts themselves, so every range (``_bucket``, rising with the order) holds
    about as many distinct values as any other, wherever on the number line these lie.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = value_counts(df, keys, value).repartitionByRange(parts, *keys, value)
    return cut_lineage(dealt.withColumn("_bucket", F.spark_partition_id()))


def accumulated(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows of :func:`counted` with ``before`` (rows with a lower value) and ``total``: a prefix sum over the ranges."""
    summed = running_total(counts, keys, F.col("_bucket"), [F.col(value)], F.col("n"), "before")
    if not keys:
        return summed.withColumn("total", counts.agg(F.sum("n").alias("t")).scalar())
    return null_safe_join(summed, counts.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def cumulative(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of a numeric column with ``n``, ``before`` (rows with a lower value) and ``total``."""
    return accumulated(counted(df, keys, value), keys, value)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``, plus ``n``."""
    return quantiles_of(cumulative(df, keys, value), keys, value, probs)


def quantiles_of(ranked: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """As :func:`quantiles`, from accumulated counts.

    Nothing is gathered per group: the two neighbours of each position are picked out of the counts.
    """
    picks = []
    for name, p in probs.items():
        position = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        holds = lambda i: (F.col("before") <= i) & (i < F.col("before") + F.col("n"))
        picks += [
            F.max(F.when(holds(low), F.col(value).cast("double"))).alias(f"_lo_{name}"),
            F.max(F.when(holds(high), F.col(value).cast("double"))).alias(f"_hi_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(F.max("total").alias("n"), *picks)
    columns = []
    for name, p in probs.items():
        position = (F.col("n") - 1) * F.lit(float(p))
        part = position - F.floor(position)
        columns.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * part).alias(name))
    return found.select(*keys, "n", *columns)


def batches(df: DataFrame, key: Sequence[str], size: int, out: str = "batch") -> DataFrame:
    """Add ``out``: a number from 0 shared by ``size`` rows, by fewer only in the last batch; rows are unique on ``key``."""
    numbered = number_by_hash(df, key, "_place")
    return numbered.withColumn(out, whole_div(F.col("_place") - 1, F.lit(size))).drop("_place")
