"""Result shaping, vetting and profiling over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions.plan import spread
from matchlake.operators import shaping as sh
from matchlake.operators.profiling import profile
from matchlake.operators.vetting import vet
from matchlake.plans.checks import check
from matchlake.plans.tables import Tables

# Columns of the given tables by the kind that shapes care about.
NUMBERS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"], "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_size", "p_retailprice"], "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "events": ["event_id", "user_id", "value"], "documents": ["doc_id", "n_chars"], "embeddings": ["vec_id", "label"],
    "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn"],
}
TEXTS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"], "embeddings": [], "pages": ["url", "html"], "benchmark": ["text"],
    "labels": [], "conversations": ["role", "text"],
}
TIMES = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}
ROW_ORDER = {
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    "conversations": ["conv_id", "turn"],
}


def tables(t: Tables):
    return {name: t.read(name) for name in NUMBERS}


@check("shape_coerce_numeric", """
SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE p_type END AS DOUBLE) AS mixed, p_name FROM part""")
def _(t: Tables):
    mixed = F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.col("p_type"))
    return sh.coerce_numeric(t.part.select("p_partkey", mixed.alias("mixed"), "p_name"))


def _eligible_sql() -> str:
    parts = []
    for name, numbers in NUMBERS.items():
        turned = " + ".join([f"coalesce(max(CAST(TRY_CAST({c} AS DOUBLE) IS NOT NULL AS INTEGER)), 0)" for c in TEXTS[name]]) or "0"
        parts.append(f"SELECT '{name}' AS table_name, {len(numbers)} + {turned} AS a, {len(TEXTS[name])} - ({turned}) AS b, count(*) AS c FROM {name}")
    shapes = " UNION ALL ".join(
        f"SELECT table_name, CAST(a AS INTEGER) AS n_numeric, CAST(b AS INTEGER) AS n_text, c AS n_rows, '{shape}' AS shape, {rule} AS fits FROM counted"
        for shape, rule in {
            "Bar Chart": "a >= 1 AND b >= 1", "Line Chart": "a >= 1 AND c > 1", "Scatter Plot": "a >= 2",
            "Pie Chart": "a = 1 AND b = 1", "Bubble Chart": "a >= 3", "Histogram": "a >= 1", "Box Plot": "a >= 1",
            "Violin Plot": "a >= 1", "Treemap": "a = 1 AND b >= 1", "Sunburst Chart": "a = 1 AND b >= 1",
            "Heatmap": "a = 1 AND b >= 2", "Radar Chart": "a >= 3 AND b >= 1", "Sankey Diagram": "a = 1 AND b = 2",
            "Funnel Chart": "a >= 1 AND b >= 1",
        }.items()
    )
    return f"WITH counted AS ({' UNION ALL '.join(parts)}) {shapes}"


@check("shape_profile", _eligible_sql())
def _(t: Tables):
    return sh.eligible_shapes(tables(t))


@check("shape_filter", """
SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 10 AND 20.5 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'""")
def _(t: Tables):
    kept = sh.apply_filters(
        t.lineitem,
        {"l_returnflag": ["A", "N"], "l_quantity": (10, 20.5), "missing": ["x"],
         "l_shipdate": (F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1999-12-31").cast("timestamp_ntz"))},
    )
    return kept.select("l_orderkey", "l_quantity", "l_returnflag")


@check("shape_ranges", """
SELECT 'l_quantity' AS column_name, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem
UNION ALL SELECT 'l_linenumber', min(l_linenumber), max(l_linenumber) FROM lineitem""")
def _(t: Tables):
    return sh.ranges(t.lineitem, ["l_quantity", "l_linenumber"])


@check("shape_summarise", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice,
       count(l_tax) AS l_tax, round(avg(l_discount), 6) AS l_discount, arg_min(l_partkey, (l_orderkey, l_linenumber, l_partkey)) AS l_partkey
FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    out = sh.summarise(
        t.lineitem, ["l_returnflag", "l_linestatus"],
        {"l_quantity": "sum", "l_extendedprice": "max", "l_tax": "count", "l_discount": "mean"},
        ["l_partkey"], ["l_orderkey", "l_linenumber", "l_partkey"],
    )
    return out.withColumn("l_discount", F.round("l_discount", 6))


@check("shape_bar", "SELECT p_brand, sum(p_size) AS sizes, count(*) AS parts FROM part GROUP BY 1")
def _(t: Tables):
    sums = t.part.groupBy("p_brand").agg(F.sum("p_size").alias("sizes"), F.count(F.lit(1)).alias("parts"))
    return sh.bar(sums, "p_brand", ["sizes", "parts"])


@check("shape_line", """
WITH months AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS orders, count(DISTINCT o_custkey) AS customers
                FROM orders GROUP BY 1, 2)
SELECT month, o_orderstatus, 'orders' AS series, CAST(orders AS DOUBLE) AS y FROM months
UNION ALL SELECT month, o_orderstatus, 'customers', customers FROM months""")
def _(t: Tables):
    months = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )
    return sh.line(months, "month", ["orders", "customers"], "o_orderstatus")


@check("shape_trend_ols", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       count(*) AS n FROM lineitem GROUP BY 1""")
def _(t: Tables):
    fit = sh.trend_ols(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return fit.select(
        "l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n",
    )


@check("shape_trend_line", """
WITH fit AS (SELECT regr_slope(p_retailprice, p_size) AS a, regr_intercept(p_retailprice, p_size) AS b FROM part)
SELECT DISTINCT p_size, round(b + a * p_size, 4) AS fitted FROM part, fit""")
def _(t: Tables):
    return sh.trend_line(t.part, "p_size", "p_retailprice").withColumn("fitted", F.round("fitted", 4))


@check("shape_trend_lowess", """
WITH pts AS (SELECT CAST(p_size AS DOUBLE) AS x, count(*) AS n, sum(p_retailprice) AS sy FROM part GROUP BY 1),
ends AS (SELECT min(x) AS lo, max(x) AS hi, sum(n) AS total FROM pts),
grid AS (SELECT i, lo + (hi - lo) * i / 49.0 AS gx, total FROM ends, range(0, 50) r(i)),
d AS (SELECT i, gx, total, x, n, sy, abs(x - gx) AS d, sum(n) OVER (PARTITION BY i ORDER BY abs(x - gx), x ROWS UNBOUNDED PRECEDING) AS upto FROM grid, pts),
h AS (SELECT *, min(CASE WHEN upto >= floor(total * (2.0 / 3) + 1e-10) THEN d END) OVER (PARTITION BY i) AS h FROM d),
w AS (SELECT *, CASE WHEN d < h THEN (1 - (d / h) ** 3) ** 3 ELSE 0 END AS w, x - gx AS dx FROM h),
s AS (SELECT i, gx, sum(w * n) AS s0, sum(w * n * dx) AS s1, sum(w * n * dx * dx) AS s2, sum(w * sy) AS t0, sum(w * sy * dx) AS t1 FROM w GROUP BY 1, 2)
SELECT CAST(i AS INTEGER) AS grid_place, round(gx, 6) AS p_size, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 4) AS smoothed FROM s""")
def _(t: Tables):
    out = sh.trend_lowess(t.part, "p_size", "p_retailprice")
    return out.withColumn("p_size", F.round("p_size", 6)).withColumn("smoothed", F.round("smoothed", 4))


@check("shape_trend_lowess_prices", """
WITH pts AS (SELECT CAST(p_retailprice AS DOUBLE) AS x, count(*) AS n, sum(p_size) AS sy FROM part GROUP BY 1),
ends AS (SELECT min(x) AS lo, max(x) AS hi, sum(n) AS total FROM pts),
grid AS (SELECT i, lo + (hi - lo) * i / 49.0 AS gx, total FROM ends, range(0, 50) r(i)),
d AS (SELECT i, gx, total, x, n, sy, abs(x - gx) AS d, sum(n) OVER (PARTITION BY i ORDER BY abs(x - gx), x ROWS UNBOUNDED PRECEDING) AS upto FROM grid, pts),
h AS (SELECT *, min(CASE WHEN upto >= floor(total * (2.0 / 3) + 1e-10) THEN d END) OVER (PARTITION BY i) AS h FROM d),
w AS (SELECT *, CASE WHEN d < h THEN (1 - (d / h) ** 3) ** 3 ELSE 0 END AS w, x - gx AS dx FROM h),
s AS (SELECT i, gx, sum(w * n) AS s0, sum(w * n * dx) AS s1, sum(w * n * dx * dx) AS s2, sum(w * sy) AS t0, sum(w * sy * dx) AS t1 FROM w GROUP BY 1, 2)
SELECT CAST(i AS INTEGER) AS grid_place, round(gx, 4) AS p_retailprice, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 4) AS smoothed FROM s""")
def _(t: Tables):
    out = sh.trend_lowess(t.part, "p_retailprice", "p_size")
    return out.withColumn("p_retailprice", F.round("p_retailprice", 4)).withColumn("smoothed", F.round("smoothed", 4))


@check("shape_trend_lowess_robust", """
WITH raw AS (SELECT CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y FROM part),
pts AS (SELECT x, count(*) AS n, sum(y) AS sy FROM raw GROUP BY 1),
ends AS (SELECT min(x) AS lo, max(x) AS hi, sum(n) AS total FROM pts),
grid AS (SELECT i, lo + (hi - lo) * i / 49.0 AS gx, total FROM ends, range(0, 50) r(i)),
d AS (SELECT i, gx, total, x, n, sy, abs(x - gx) AS d, sum(n) OVER (PARTITION BY i ORDER BY abs(x - gx), x ROWS UNBOUNDED PRECEDING) AS upto FROM grid, pts),
h AS (SELECT *, min(CASE WHEN upto >= floor(total * (2.0 / 3) + 1e-10) THEN d END) OVER (PARTITION BY i) AS h FROM d),
w AS (SELECT *, CASE WHEN d < h THEN (1 - (d / h) ** 3) ** 3 ELSE 0 END AS w, x - gx AS dx FROM h),
s AS (SELECT i, gx, sum(w * n) AS s0, sum(w * n * dx) AS s1, sum(w * n * dx * dx) AS s2, sum(w * sy) AS t0, sum(w * sy * dx) AS t1 FROM w GROUP BY 1, 2),
c AS (SELECT i, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) AS v FROM s),
t AS (SELECT x, y, (x - lo) / (hi - lo) * 49 AS t, least(floor((x - lo) / (hi - lo) * 49), 48) AS k FROM raw, ends),
r AS (SELECT x, y, abs(y - (a.v + (b.v - a.v) * (t - k))) AS r FROM t JOIN c a ON a.i = k JOIN c b ON b.i = k + 1),
q AS (SELECT x, y, r / (6 * (SELECT quantile_cont(r, 0.5) FROM r)) AS q FROM r),
m AS (SELECT x, sum(CASE WHEN q < 1 THEN (1 - q * q) ** 2 ELSE 0 END) AS mass, sum(CASE WHEN q < 1 THEN (1 - q * q) ** 2 ELSE 0 END * y) AS my FROM q GROUP BY 1),
f AS (SELECT i, gx, sum(w * mass) AS s0, sum(w * mass * dx) AS s1, sum(w * mass * dx * dx) AS s2, sum(w * my) AS t0, sum(w * my * dx) AS t1 FROM w JOIN m USING (x) GROUP BY 1, 2)
SELECT CAST(i AS INTEGER) AS grid_place, round(gx, 6) AS p_size, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 4) AS smoothed FROM f""")
def _(t: Tables):
    out = sh.trend_lowess(t.part, "p_size", "p_retailprice", rounds=1)
    return out.withColumn("p_size", F.round("p_size", 6)).withColumn("smoothed", F.round("smoothed", 4))


@check("shape_donut", """
WITH top AS (SELECT p_brand, sum(p_size) AS v FROM part GROUP BY 1 ORDER BY v DESC, p_brand LIMIT 12)
SELECT p_brand, CAST(v AS BIGINT) AS sizes, round(CAST(v AS DOUBLE) / sum(v) OVER (), 6) AS share FROM top""")
def _(t: Tables):
    sums = t.part.groupBy("p_brand").agg(F.sum("p_size").alias("sizes"))
    return sh.donut(sums, "p_brand", "sizes").withColumn("share", F.round("share", 6))


_PLACES = """
WITH sums AS (
  SELECT r_name, n_name, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_nationkey
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
"""


def places(t: Tables):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "c_mktsegment", F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"), "c_nationkey")
    )


@check("shape_sunburst", _PLACES + """
SELECT r_name, n_name, c_mktsegment, CAST(3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment) AS INTEGER) AS level,
       CAST(sum(cents) AS BIGINT) AS value
FROM sums GROUP BY ROLLUP (r_name, n_name, c_mktsegment) HAVING grouping(r_name) = 0""")
def _(t: Tables):
    return sh.hierarchy(places(t), ["r_name", "n_name", "c_mktsegment"], "cents")


@check("shape_treemap", _PLACES + """
SELECT r_name, n_name, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level, CAST(sum(cents) AS BIGINT) AS value,
       round(CAST(sum(c_nationkey * cents) AS DOUBLE) / sum(cents), 6) AS color
FROM sums GROUP BY ROLLUP (r_name, n_name)""")
def _(t: Tables):
    out = sh.hierarchy(places(t), ["r_name", "n_name"], "cents", color="c_nationkey", root=True)
    return out.withColumn("color", F.round("color", 6))


@check("shape_rose", "SELECT event_type, round(sum(value), 2) AS radius FROM events GROUP BY 1")
def _(t: Tables):
    return sh.rose(t.events, "event_type", "value").withColumn("radius", F.round("radius", 2))


@check("shape_scatter", "SELECT p_size, p_retailprice, p_type FROM part")
def _(t: Tables):
    return sh.scatter(t.part, "p_size", "p_retailprice", color="p_type", size="p_size")


@check("shape_histogram", """
WITH ends AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_type, CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin,
       round(lo + least(floor((value - lo) / (hi - lo) * 30), 29) * ((hi - lo) / 30), 6) AS bin_start,
       round(lo + (least(floor((value - lo) / (hi - lo) * 30), 29) + 1) * ((hi - lo) / 30), 6) AS bin_end, count(*) AS n
FROM events, ends GROUP BY 1, 2, 3, 4""")
def _(t: Tables):
    out = sh.histogram(t.events, "value", by=["event_type"])
    return out.withColumn("bin_start", F.round("bin_start", 6)).withColumn("bin_end", F.round("bin_end", 6))


@check("shape_density2d", """
WITH ends AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b, min(l_quantity) AS c, max(l_quantity) AS d FROM lineitem),
cells AS (SELECT CAST(least(floor((l_extendedprice - a) / (b - a) * 30), 29) AS INTEGER) AS x_bin,
                 CAST(least(floor((l_quantity - c) / (d - c) * 30), 29) AS INTEGER) AS y_bin FROM lineitem, ends)
SELECT x_bin, y_bin, count(*) AS n FROM cells GROUP BY CUBE (x_bin, y_bin) HAVING grouping(x_bin) + grouping(y_bin) < 2""")
def _(t: Tables):
    return sh.density2d(t.lineitem, "l_extendedprice", "l_quantity")


@check("shape_ecdf", """
SELECT DISTINCT event_type, value, count(*) OVER (PARTITION BY event_type, value) AS n,
       round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 8) AS share FROM events""")
def _(t: Tables):
    return sh.ecdf(t.events, "value", ["event_type"]).withColumn("share", F.round("share", 8))


_QUARTILES = """
WITH q AS (SELECT {by} AS cat, count(*) AS n, quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS median, quantile_cont({y}, 0.75) AS q3
           FROM {table} GROUP BY 1)"""


@check("shape_box", _QUARTILES.format(by="l_returnflag", y="l_extendedprice", table="lineitem") + """
SELECT cat AS l_returnflag, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (NOT l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM lineitem JOIN q ON cat = l_returnflag GROUP BY cat, n, q1, median, q3""")
def _(t: Tables):
    out = sh.box(t.lineitem, "l_extendedprice", ["l_returnflag"])
    return out.select(
        "l_returnflag", "n", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3"]], "whisker_low", "whisker_high", "outliers"
    )


@check("shape_box_outliers", _QUARTILES.format(by="event_type", y="value", table="events") + """
SELECT event_id, event_type, value FROM events JOIN q ON cat = event_type
WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def _(t: Tables):
    return sh.box_outliers(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])


@check("shape_violin", _QUARTILES.format(by="event_type", y="value", table="events") + """,
g AS (SELECT event_type AS cat, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd FROM events GROUP BY 1),
f AS (SELECT q.*, lo, hi, least(sd, (q3 - q1) / 1.349) * 1.06 * n ** (-0.2) AS h FROM q JOIN g ON g.cat = q.cat),
ends AS (SELECT min(value) AS l, max(value) AS r FROM events),
bins AS (SELECT event_type AS cat, least(floor((value - l) / (r - l) * 256), 255) AS bin, count(*) AS k, sum(value) / count(*) AS c
         FROM events, ends GROUP BY 1, 2),
pts AS (SELECT f.*, i, lo - 2 * h + (hi - lo + 4 * h) * i / 49 AS gx FROM f, range(0, 50) r(i))
SELECT p.cat AS event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, CAST(i AS INTEGER) AS grid_place,
       round(gx, 5) AS grid_value, round(sum(exp(-0.5 * ((gx - c) / h) ** 2) * k / (n * h * sqrt(2 * pi()))), 8) AS density
FROM pts p JOIN bins b ON b.cat = p.cat GROUP BY ALL""")
def _(t: Tables):
    out = sh.violin(t.events, "value", ["event_type"])
    return out.select(
        "event_type", "n", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3"]], "grid_place",
        F.round("grid_value", 5).alias("grid_value"), F.round("density", 8).alias("density"),
    )


@check("shape_heatmap", """
WITH data AS (SELECT c_nationkey, day, o_totalprice FROM
  (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders) JOIN customer ON c_custkey = o_custkey)
SELECT c_nationkey, day, coalesce(round(avg(o_totalprice), 6), 0) AS mean
FROM (SELECT DISTINCT c_nationkey FROM data) CROSS JOIN (SELECT DISTINCT day FROM data) LEFT JOIN data USING (c_nationkey, day)
GROUP BY ALL""")
def _(t: Tables):
    data = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    out = sh.heatmap(data.withColumn("day", F.to_date("o_orderdate")), "day", "c_nationkey", "o_totalprice")
    return out.withColumn("mean", F.round("mean", 6))


@check("shape_radar", """
WITH m AS (SELECT p_brand, CAST(sum(p_size) AS DOUBLE) AS sizes, CAST(count(*) AS DOUBLE) AS parts, 5.0 AS flat FROM part
           WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1),
l AS (UNPIVOT m ON sizes, parts, flat INTO NAME metric VALUE raw_value)
SELECT p_brand, metric, CAST(raw_value AS DOUBLE) AS raw_value,
       coalesce(round(CAST(raw_value - min(raw_value) OVER w AS DOUBLE) / nullif(max(raw_value) OVER w - min(raw_value) OVER w, 0) * 100, 6), 0) AS shown
FROM l WINDOW w AS (PARTITION BY metric)""")
def _(t: Tables):
    sums = t.part.groupBy("p_brand").agg(
        F.sum("p_size").alias("sizes"), F.count(F.lit(1)).alias("parts"), F.lit(5.0).alias("flat")
    )
    out = sh.radar(sums, "p_brand", ["Brand#1", "Brand#2", "Brand#3"], ["sizes", "parts", "flat"])
    return out.withColumn("shown", F.round("shown", 6))


@check("shape_sankey", """
WITH flow AS (SELECT r_name AS src, n_name AS dst, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey
              JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2),
nodes AS (SELECT label, row_number() OVER (ORDER BY substr(md5(label), 1, 3), label) - 1 AS id FROM (SELECT src AS label FROM flow UNION SELECT dst FROM flow))
SELECT a.id AS source_id, b.id AS target_id, customers FROM flow JOIN nodes a ON a.label = src JOIN nodes b ON b.label = dst""")
def _(t: Tables):
    flow = places(t).groupBy(F.col("r_name").alias("src"), F.col("n_name").alias("dst")).agg(F.count(F.lit(1)).alias("customers"))
    return sh.sankey(flow, "src", "dst", "customers")[1]


@check("shape_pie", """
WITH top AS (SELECT p_name, count(*) AS v FROM part GROUP BY 1 ORDER BY v DESC, p_name LIMIT 10)
SELECT p_name, v AS parts, round(CAST(v AS DOUBLE) / sum(v) OVER (), 6) AS share FROM top""")
def _(t: Tables):
    sums = t.part.groupBy("p_name").agg(F.count(F.lit(1)).alias("parts"))
    return sh.pie(sums, "p_name", "parts").withColumn("share", F.round("share", 6))


@check("shape_funnel", """
WITH s AS (SELECT event_type, count(*) AS total, list_position(['view', 'click', 'signup', 'purchase'], event_type) AS place FROM events
           WHERE event_type <> 'error' GROUP BY 1)
SELECT event_type, total, CAST(place AS INTEGER) AS place, round(CAST(total AS DOUBLE) / lag(total) OVER (ORDER BY place), 6) AS step_ratio FROM s""")
def _(t: Tables):
    ones = t.events.withColumn("one", F.lit(1))
    out = sh.funnel(ones, "event_type", "one", ["view", "click", "signup", "purchase"])
    return out.withColumn("step_ratio", F.round("step_ratio", 6))


@check("vet_queries", r"""
WITH q AS (SELECT doc_id, CASE n_chars % 7 WHEN 0 THEN 'SELECT ' || text WHEN 1 THEN '```sql' || chr(10) || 'with ' || text || chr(10) || '```'
    WHEN 2 THEN 'select 1; ' || text WHEN 3 THEN '  SELECT ' || text || ';; ' WHEN 4 THEN 'Select 1 -- ' || text WHEN 5 THEN text ELSE 'SELECT 1 FROM x' || chr(10) || 'DROP' || chr(10) || text END AS raw FROM documents),
c AS (SELECT doc_id, CASE WHEN raw LIKE '```sql%' THEN trim(substr(raw, 7, length(raw) - 9), ' ' || chr(10)) ELSE trim(raw, ' ' || chr(10)) END AS query FROM q),
r AS (SELECT doc_id, query, CASE
    WHEN query = '' THEN 'empty' WHEN NOT regexp_matches(lower(query), '^(select|with)([^a-z0-9_]|$)') THEN 'not a query'
    WHEN regexp_matches(lower(query), '(^|[^a-z0-9_])(drop|delete|insert|update|truncate|alter|create|grant|revoke|exec|execute|pg_sleep|waitfor|dbms_lock)([^a-z0-9_]|$)') THEN 'blocked word'
    WHEN contains(rtrim(query, ';'), ';') THEN 'several statements'
    WHEN contains(query, '--') OR contains(query, '/*') OR contains(query, '*/') THEN 'comment' END AS reason FROM c)
SELECT doc_id, md5(query) AS query_md5, reason, reason IS NULL AS accepted FROM r""")
def _(t: Tables):
    k, text = F.col("n_chars") % 7, F.col("text")
    raw = (
        F.when(k == 0, F.concat(F.lit("SELECT "), text)).when(k == 1, F.concat(F.lit("```sql\nwith "), text, F.lit("\n```")))
        .when(k == 2, F.concat(F.lit("select 1; "), text)).when(k == 3, F.concat(F.lit("  SELECT "), text, F.lit(";; ")))
        .when(k == 4, F.concat(F.lit("Select 1 -- "), text)).when(k == 5, text)
        .otherwise(F.concat(F.lit("SELECT 1 FROM x\nDROP\n"), text))
    )
    texts = spread(t.documents, "doc_id")
    return vet(texts.select("doc_id", raw.alias("raw")), "raw").select(
        "doc_id", F.md5("query").alias("query_md5"), "reason", "accepted"
    )


def _profile_sql() -> str:
    parts = []
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
    for name in NUMBERS:
        for c in [*NUMBERS[name], *TEXTS[name], *TIMES.get(name, [])]:
            kind = f"(SELECT CASE any_value(typeof({c})) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in kinds.items()) + f" END FROM {name})"
            order = ", ".join(ROW_ORDER.get(name, [NUMBERS[name][0]]))
            sample = f"(SELECT list(v) FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {name} ORDER BY {order} LIMIT 3))"
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, {kind} AS data_type, NULL AS comment, count(*) AS n_rows, "
                f"count(*) - count({c}) AS n_nulls, "
                f"CASE CAST(min({c}) AS VARCHAR) WHEN '-0.0' THEN '0.0' ELSE CAST(min({c}) AS VARCHAR) END AS low, "
                f"CASE CAST(max({c}) AS VARCHAR) WHEN '-0.0' THEN '0.0' ELSE CAST(max({c}) AS VARCHAR) END AS high, {sample} AS samples FROM {name}"
            )
    parts.append("SELECT 'embeddings', 'embedding', 'array<float>', NULL, count(*), count(*) - count(embedding), NULL, NULL, NULL FROM embeddings")
    return " UNION ALL ".join(parts)


@check("profile_tables", _profile_sql())
def _(t: Tables):
    order = {name: ROW_ORDER.get(name, [NUMBERS[name][0]]) for name in NUMBERS}
    return profile(tables(t), order)
