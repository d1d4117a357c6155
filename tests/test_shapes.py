import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchlake.operators import enrich as en
from matchlake.operators import shaping as sh
from matchlake.operators.profiling import profile
from matchlake.operators.vetting import vet


@pytest.fixture(scope="module")
def values(spark):
    rnd = np.random.default_rng(1)
    return spark.createDataFrame([(i, "ab"[i % 2], float(v)) for i, v in enumerate(rnd.normal(size=400))], "i int, g string, v double")


def test_coerce(spark):
    df = spark.createDataFrame([("1", "x", "5"), ("b", "y", None)], "m string, t string, n string")
    assert rows(sh.coerce_numeric(df)) == [(1.0, "x", 5.0), (None, "y", None)]


def test_summarise_drops_empty_keys_and_sums_nothing_to_zero(spark):
    df = spark.createDataFrame([("a", None, None, 2), ("a", None, "q", 1), (None, 5, "z", 0)], "k string, v int, f string, o int")
    assert rows(sh.summarise(df, ["k"], {"v": "sum"}, ["f"], ["o"])) == [("a", 0, "q")]


def test_box_and_violin(values):
    one = sh.box(values, "v").first()
    data = np.array([r.v for r in values.collect()])
    q1, q3 = np.quantile(data, [0.25, 0.75])
    inside = data[(data >= q1 - 1.5 * (q3 - q1)) & (data <= q3 + 1.5 * (q3 - q1))]
    assert np.allclose([one.q1, one.q3, one.whisker_low, one.whisker_high], [q1, q3, inside.min(), inside.max()])
    assert one.outliers == len(data) - len(inside) == sh.box_outliers(values, "v").count()
    curve = sorted((r.g, r.grid_value, r.density) for r in sh.violin(values, "v", ["g"]).collect())
    for g in "ab":
        part = [(x, d) for k, x, d in curve if k == g]
        assert abs(np.trapezoid([d for _, d in part], [x for x, _ in part]) - 1) < 0.03


def test_lowess_follows_a_line(spark):
    df = spark.range(200).selectExpr("CAST(id AS DOUBLE) AS x", "3.0 * id + 2 AS y")
    for r in sh.trend_lowess(df, "x", "y").collect():
        assert abs(r.smoothed - (3 * r.x + 2)) < 1e-6


def test_lowess_with_a_far_out_x(spark):
    xs, ys = np.append(np.arange(3000) / 7.0, 1e6), np.append(np.sin(np.arange(3000) / 200.0), 5.0)
    df = spark.createDataFrame(list(zip(xs.tolist(), ys.tolist())), "x double, y double")
    for r in sh.trend_lowess(df, "x", "y", frac=0.1).collect():
        d = np.abs(xs - r.x)
        h = np.sort(d)[int(len(xs) * 0.1) - 1]
        w = np.clip(1 - (d / h) ** 3, 0, None) ** 3
        mean = (w * xs).sum() / w.sum()
        my = (w * ys).sum() / w.sum()
        spread = (w * (xs - mean) ** 2).sum()
        assert abs(r.smoothed - (my + (w * (xs - mean) * (ys - my)).sum() / spread * (r.x - mean))) < 1e-3 * max(1, abs(r.smoothed))


def plain_lowess(xs, ys, frac, grid, rounds):
    """Local lines at the places, then rounds of bisquare weights, over all rows at once."""
    places, weights = np.linspace(xs.min(), xs.max(), grid), np.ones(len(xs))
    for k in range(rounds + 1):
        curve = []
        for at in places:
            d = np.abs(xs - at)
            h = np.sort(d)[int(len(xs) * frac + 1e-10) - 1]
            w = np.where(d < h, np.clip(1 - (d / h) ** 3, 0, None) ** 3, 0.0) * weights
            mean, level = (w * xs).sum() / w.sum(), (w * ys).sum() / w.sum()
            slope = (w * (xs - mean) * (ys - level)).sum() / (w * (xs - mean) ** 2).sum()
            curve.append(level + slope * (at - mean))
        rest = np.abs(ys - np.interp(xs, places, curve))
        weights = np.clip(1 - (rest / (6 * np.median(rest))) ** 2, 0, None) ** 2
    return curve


@pytest.mark.parametrize("rounds", [1, 3])
def test_lowess_with_robustness_rounds(spark, rounds):
    rng = np.random.default_rng(2)
    xs = np.repeat(rng.random(150) * 20, 2)
    ys = 2 * xs + rng.standard_normal(300)
    ys[rng.choice(300, 25, replace=False)] += 200
    df = spark.createDataFrame(list(zip(xs.tolist(), ys.tolist())) + [(None, 1.0), (2.0, None)], "x double, y double").repartition(3)
    got = [r.smoothed for r in sh.trend_lowess(df, "x", "y", frac=0.5, grid=20, rounds=rounds).orderBy("grid_place").collect()]
    assert np.allclose(got, plain_lowess(xs, ys, 0.5, 20, rounds), rtol=1e-8)
    if rounds == 3:
        assert np.abs(np.array(got) - 2 * np.linspace(xs.min(), xs.max(), 20)).max() < 1.5


def test_lowess_rounds_without_spread(spark):
    flat = spark.createDataFrame([(3.0, 5.0)] * 4, "x double, y double")
    assert {r.smoothed for r in sh.trend_lowess(flat, "x", "y", rounds=2).collect()} == {5.0}
    assert sh.trend_lowess(flat.where("false"), "x", "y", rounds=2).count() == 0


def test_heatmap_shows_every_place(spark):
    df = spark.createDataFrame([("a", i, 1.0 * i) for i in range(1500)] + [("b", 7, 3.0), ("b", 7, 5.0), (None, 1, 1.0)], "y string, x int, z double")
    got = {(r.y, r.x): r["mean"] for r in sh.heatmap(df, "x", "y", "z").collect()}
    assert len(got) == 3000 and got["a", 1499] == 1499.0 and got["b", 7] == 4.0 and got["b", 8] == 0.0


def test_histogram_limits(values):
    assert sum(r.n for r in sh.histogram(values, "v", 10).collect()) == 400
    with pytest.raises(ValueError):
        sh.histogram(values, "v", 3)
    flat = values.withColumn("v", F.lit(2.0))
    assert rows(sh.histogram(flat, "v"), "bin", "n") == [(0, 400)]


def test_ecdf_ends_at_one(values):
    assert max(r.share for r in sh.ecdf(values, "v").collect()) == 1.0


def test_sankey_nodes(spark):
    df = spark.createDataFrame([("a", "b", 1), ("b", "c", 2)], "s string, t string, v int")
    nodes, links = sh.sankey(df, "s", "t", "v")
    label = {r.node_id: r.label for r in nodes.collect()}
    assert sorted(label) == [0, 1, 2]
    assert sorted((label[r.source_id], label[r.target_id], r.v) for r in links.collect()) == [("a", "b", 1), ("b", "c", 2)]


def test_vetting(spark):
    texts = {
        "select 1": None, "```sql\nWITH a AS (SELECT 1) SELECT * FROM a;\n```": None, "'''sql select 2'''": None,
        "select 1; select 2": "several statements", "select 1 -- x": "comment", "select\ndrop\ntable": "blocked word",
        "select dropped, updates from t": None, "insert into t": "not a query", "  ": "empty", "selected": "not a query",
        "with x as (DELETE FROM y) select 1": "blocked word", "select 1;;": None, "select /* a */ 1": "comment",
    }
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    assert {r.raw: r.reason for r in vet(df, "raw").collect()} == texts


def test_profile(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "c"), (4, "a")], "i int, s string").withMetadata("s", {"comment": "text"})
    got = {r.column_name: r for r in profile({"t": df, "u": df}, {"t": ["i"]}, ignore=["u"]).collect()}
    assert (got["s"].n_nulls, got["s"].low, got["s"].high, got["s"].samples, got["s"].comment) == (1, "a", "c", [None, "b", "c"], "text")
    assert got["i"].samples == ["1", "2", "3"] and got["i"].n_rows == 4


def test_enrichment(spark):
    good = '```json\n{"batting_hand": "Right-hand bat", "date_of_birth": "1900-01-01", "full_name": "A B C"}\n```'
    replies = spark.createDataFrame([("p1", good), ("p2", "[1]"), ("p3", "no")], "identifier string, reply string")
    ok, bad = en.parse_player_replies(replies)
    assert rows(bad, "identifier") == [("p2",), ("p3",)]
    columns = ", ".join(f"{c} {'date' if c == 'date_of_birth' else 'string'}" for c in
                        ["identifier", "batting_hand", "bowling_hand", "bowling_style", "date_of_birth", "country", "player_role", "full_name", "first_last_name"])
    players = spark.createDataFrame([("p1", "N/A", None, "RAFM", None, "X", None, None, None),
                                     ("p2", "N/A", "N/A", "N/A", None, "N/A", "N/A", None, None)], columns)
    merged = en.merge_attributes(players, ok.select("identifier", "parsed.*"))
    done = en.with_short_names(en.reset_unresolved(en.recode(merged, "bowling_style")))
    assert rows(done, "identifier", "batting_hand", "bowling_style", "date_of_birth", "country", "first_last_name") == [
        ("p1", "Right-hand bat", "RFM/RAFM", None, "X", "A C"), ("p2", None, None, None, None, None)]
    odd = spark.createDataFrame([("Both", "OB,SLA")], "bowling_hand string, bowling_style string")
    flagged = en.validate(odd, {k: en.ATTRIBUTE_DOMAINS[k] for k in odd.columns}).first()
    assert flagged.invalid == ["bowling_hand", "bowling_style"]


def test_heatmap_has_every_cell_and_no_axis_list(spark):
    data = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("b", 2, 5.0), ("b", None, 1.0), (None, 3, 1.0)], "y string, x int, z double")
    out = sh.heatmap(data, "x", "y", "z")
    assert rows(out, "y", "x", "mean") == [("a", 1, 3.0), ("a", 2, 0.0), ("b", 1, 0.0), ("b", 2, 5.0)]
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sh.heatmap(data.where("false"), "x", "y", "z").count() == 0


def test_box_without_categories_skips_nan(spark):
    data = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(float("nan"),), (None,)], "v double")
    got = sh.box(data, "v").first()
    assert (got.n, got.q1, got.median, got.q3, got.whisker_low, got.whisker_high, got.outliers) == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
