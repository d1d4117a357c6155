import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchlake.operators import ranking as rk


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, ties, negative and far-out values."""
    rnd = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"g{i % 50}", i, rnd.choice([-5.5, 0.0, 1.0, 2.25, rnd.uniform(-10, 10), 1e9 * rnd.random()]))
            for i in range(3000)]
    return spark.createDataFrame(data, "g string, i long, v double").cache()


def test_running_total_equals_the_window(skewed):
    w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.select("i", F.coalesce(F.sum("i").over(w), F.lit(0)).alias("t"))
    got = rk.running_total(skewed, ["g"], F.floor(F.col("i") / 100), [F.col("i")], F.col("i"), "t")
    assert rows(got, "i", "t") == rows(want)


def test_number_rows_with_a_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, i int")
    got = rk.number_rows(df, ["g"], F.col("i") % 2, [F.col("i")], "n")
    assert rows(got) == [("a", 2, 1), (None, 1, 1), (None, 3, 2)]


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_the_window(skewed, descending):
    order = F.desc("v") if descending else F.asc("v")
    want = skewed.select("i", F.rank().over(Window.orderBy(order)).cast("long"))
    assert rows(rk.rank_by(skewed, "v", "r", descending), "i", "r") == rows(want)


def test_quantiles_equal_numpy(skewed):
    got = {r.g: (r.n, r.a, r.b, r.c) for r in rk.quantiles(skewed, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.99}).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r.g, []).append(r.v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert np.allclose(got[g][1:], np.quantile(values, [0.25, 0.5, 0.99]))


def test_quantiles_without_groups(skewed):
    one = rk.quantiles(skewed, [], "v", {"m": 0.5}).first()
    assert np.isclose(one.m, np.quantile([r.v for r in skewed.collect()], 0.5))


def test_hash_numbers_are_dense_whatever_the_partitions(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("k"))
    a = rows(rk.number_by_hash(ids, ["k"], "n"))
    b = rows(rk.number_by_hash(ids.repartition(7), ["k"], "n"))
    assert a == b and sorted(n for _, n in a) == list(range(1, 501))


def test_batches_are_full_but_the_last(spark):
    cut = rk.batches(spark.range(2000), ["id"], 3)
    sizes = {r["batch"]: r["count"] for r in cut.groupBy("batch").count().collect()}
    assert sizes == {b: 3 for b in range(666)} | {666: 2} and cut.select("id").distinct().count() == 2000


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "v double")
    assert rows(rk.cumulative(df, [], "v")) == [(1.0, 1, 0, 2), (2.0, 1, 1, 2)]


def test_far_out_values_spread_over_all_ranges(spark):
    """Epoch seconds: all in one octave, so buckets by size would put them into one."""
    df = spark.range(200_000).selectExpr("1.7e9 + id AS v", "id % 2 AS g")
    per_range = [r["count"] for r in rk.counted(df, [], "v").groupBy("_bucket").count().collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per_range) == parts and max(per_range) < 2 * 200_000 / parts
    got = rk.quantiles(df, ["g"], "v", {"m": 0.5}).orderBy("g").collect()
    assert [(r.g, r.n, r.m) for r in got] == [(0, 100_000, 1.7e9 + 99_999), (1, 100_000, 1.7e9 + 100_000)]
