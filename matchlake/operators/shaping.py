"""The data step behind each kind of chart: large tables in, small tables out.

Everything is reduced to groups, bins or a grid before anything is compared with anything else, so the last steps only
see as many rows as the chart has marks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.fixed_values import HISTOGRAM_BINS, PIE_SLICES, TOP_SLICES
from matchlake.functions.numbers import magnitude_bucket
from matchlake.operators.maintain import assign_key
from matchlake.operators.ranking import accumulated, counted, cumulative, null_safe_join, quantiles, quantiles_of, running_total
from matchlake.session import cut_lineage

#: Into how many blocks the places of an axis are dealt, so that no task holds all of them.
AXIS_BLOCKS = 64
BOX_QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _parses(column: str) -> Column:
    return F.col(column).try_cast("double").isNotNull()


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Text columns with any number in them become numeric; what is no number becomes NULL.

    Reads the data once to decide (a result of one row); all columns are decided in that one pass.
    """
    texts = [f.name for f in df.schema.fields if _is_text(f)]
    if not texts:
        return df
    row = df.agg(*[F.coalesce(F.max(_parses(c)), F.lit(False)).alias(c) for c in texts]).first()
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in texts and row[c] else F.col(c) for c in df.columns])


# What each shape needs, as SQL over the numbers of numeric and text columns and of rows.
SHAPE_RULES = {
    "Bar Chart": "n_numeric >= 1 AND n_text >= 1",
    "Line Chart": "n_numeric >= 1 AND n_rows > 1",
    "Scatter Plot": "n_numeric >= 2",
    "Pie Chart": "n_numeric = 1 AND n_text = 1",
    "Bubble Chart": "n_numeric >= 3",
    "Histogram": "n_numeric >= 1",
    "Box Plot": "n_numeric >= 1",
    "Violin Plot": "n_numeric >= 1",
    "Treemap": "n_numeric = 1 AND n_text >= 1",
    "Sunburst Chart": "n_numeric = 1 AND n_text >= 1",
    "Heatmap": "n_numeric = 1 AND n_text >= 2",
    "Radar Chart": "n_numeric >= 3 AND n_text >= 1",
    "Sankey Diagram": "n_numeric = 1 AND n_text = 2",
    "Funnel Chart": "n_numeric >= 1 AND n_text >= 1",
}


def eligible_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, shape): does the table fit it, counting text columns that hold numbers as numeric?"""
    rows = None
    for name, df in tables.items():
        numbers = sum(_is_number(f) for f in df.schema.fields)
        texts = [f.name for f in df.schema.fields if _is_text(f)]
        turned = F.lit(0)
        for c in texts:
            turned = turned + F.coalesce(F.max(_parses(c).cast("int")), F.lit(0))
        one = df.agg(
            F.lit(name).alias("table_name"), (F.lit(numbers) + turned).alias("n_numeric"),
            (F.lit(len(texts)) - turned).alias("n_text"), F.count(F.lit(1)).alias("n_rows"),
        )
        rows = one if rows is None else rows.unionByName(one)
    fits = F.array(*[F.struct(F.lit(s).alias("shape"), F.expr(rule).alias("fits")) for s, rule in SHAPE_RULES.items()])
    return rows.select("table_name", "n_numeric", "n_text", "n_rows", F.explode(fits).alias("f")).select(
        "table_name", "n_numeric", "n_text", "n_rows", "f.shape", "f.fits"
    )


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lowest and highest value of each numeric column, one row per column."""
    row = df.agg(*[F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in columns])
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), f"{c}.low", f"{c}.high") for c in columns])
    return row.select(F.explode(parts).alias("p")).select("p.*")


def apply_filters(df: DataFrame, filters: dict[str, Sequence]) -> DataFrame:
    """All of: text columns in a list, numeric columns in a closed range. Columns that are not there are ignored."""
    fields = {f.name: f for f in df.schema.fields}
    for column, wanted in filters.items():
        if column not in fields:
            continue
        if _is_text(fields[column]):
            df = df.where(F.col(column).isin(list(wanted)))
        else:
            df = df.where(F.col(column).between(wanted[0], wanted[1]))
    return df


def summarise(
    df: DataFrame, keys: Sequence[str], aggs: dict[str, str], firsts: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Group by columns with sum, mean, max, min or count per value column; other columns take their first value.

    Rows without a key are dropped and a sum of nothing is 0. "First" is the first non-NULL value by ``order``.
    """
    how = {
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)), "mean": F.avg, "max": F.max, "min": F.min, "count": F.count,
    }
    columns = [how[fn](c).alias(c) for c, fn in aggs.items()]
    place = F.struct(*order) if order else None
    for c in firsts:
        given = F.when(F.col(c).isNotNull(), place if order else F.col(c))
        columns.append(F.min_by(c, given).alias(c))
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*columns)


def bar(df: DataFrame, category: str, values: Sequence[str], descending: bool = True) -> DataFrame:
    """Bars sorted by their first value."""
    first = F.desc_nulls_last(values[0]) if descending else F.asc_nulls_last(values[0])
    return df.select(category, *values).orderBy(first, F.asc(category))


def line(df: DataFrame, x: str, ys: Sequence[str], color: str | None = None) -> DataFrame:
    """Points of one or more lines in long form (x, colour, series, y), sorted by x."""
    ids = [x, color] if color else [x]
    points = df.select(*ids, *[F.col(y).cast("double").alias(y) for y in ys])
    return points.unpivot(ids, list(ys), "series", "y").orderBy(*[F.asc_nulls_last(c) for c in [*ids, "series"]])


def trend_ols(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per colour: slope, intercept, r2 and number of points."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def trend_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """The fitted line at every distinct x: what is drawn over the points."""
    fit = trend_ols(df, x, y, by)
    points = df.where(F.col(x).isNotNull()).select(*by, x).distinct()
    joined = null_safe_join(points, fit, list(by)) if by else points.select(
        "*", fit.select("slope").scalar().alias("slope"), fit.select("intercept").scalar().alias("intercept")
    )
    return joined.select(*by, x, (F.col("intercept") + F.col("slope") * F.col(x)).alias("fitted"))


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number from 0; the highest value falls into the last bin."""
    width = F.nullif(high - low, F.lit(0.0))
    place = F.floor((value - low) / width * bins)
    return F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")


def _bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Lowest and highest value as scalar subqueries."""
    ends = df.agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    return ends.select("low").scalar(), ends.select("high").scalar()


def _local_lines(places: DataFrame, reaches: DataFrame, mass: str) -> DataFrame:
    """The weighted line's level at each place: ``i``, ``at``, ``smoothed``. ``mass`` is what an x weighs besides its distance."""
    reach = places.join(reaches, "i").where((F.col("d") < F.col("h")) | (F.col("d") == 0))
    u = F.col("d") / F.col("h")
    weight = F.when(F.col("h") > 0, F.when(u < 1, F.pow(1 - F.pow(u, F.lit(3)), F.lit(3))).otherwise(0.0)).otherwise(
        (F.col("d") == 0).cast("double")
    )
    w, dx = F.col("w"), F.col("x") - F.col("at")
    sums = reach.withColumn("w", weight).groupBy("i", "at").agg(
        F.sum(w * F.col(mass)).alias("s0"), F.sum(w * F.col(mass) * dx).alias("s1"),
        F.sum(w * F.col(mass) * dx * dx).alias("s2"), F.sum(w * F.col("sy")).alias("t0"),
        F.sum(w * F.col("sy") * dx).alias("t1"),
    )
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    level = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / F.nullif(det, F.lit(0.0))
    flat = F.col("t0") / F.nullif(F.col("s0"), F.lit(0.0))
    return sums.select("i", "at", F.coalesce(level, flat).alias("smoothed"))


def trend_lowess(df: DataFrame, x: str, y: str, frac: float = 2 / 3, grid: int = 50, rounds: int = 0) -> DataFrame:
    """Locally weighted line (tricube weights) at ``grid`` evenly spaced places, with so many robustness ``rounds``.

    Rows are first reduced to the distinct x with their sums. How far a place reaches comes from counts accumulated over
    buckets of the distance, so no task sees all distances of a place. A round takes each row's residual from the curve
    (linear between places) and weighs the row by the bisquare of residual over six times the exact median residual; where
    that median is 0, rows off the curve weigh nothing. Rows next to a place without a value keep their full weight.
    """
    data = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    low, high = _bounds(data, "x")

    def at_places(points: DataFrame) -> DataFrame:
        return points.withColumn("low", low).withColumn("high", high).select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i")
        ).withColumn(
            "at", F.col("low") + (F.col("high") - F.col("low")) * F.col("i") / (grid - 1)
        ).withColumn("d", F.abs(F.col("x") - F.col("at")))

    points = data.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"))
    spread = at_places(points)
    distances = spread.groupBy("i", "d").agg(F.sum("n").alias("n"))
    before = running_total(distances, ["i"], magnitude_bucket(F.col("d")), [F.col("d")], F.col("n"), "before")
    needed = F.floor(points.agg(F.sum("n").alias("all")).scalar() * F.lit(frac) + 1e-10)
    reaches = before.where(F.col("before") + F.col("n") >= needed).groupBy("i").agg(F.min("d").alias("h"))
    if rounds:
        # One row per place, read again in every round.
        reaches = cut_lineage(reaches)
    curve = _local_lines(spread, reaches, "n")
    for _ in range(rounds):
        curve = cut_lineage(curve)
        levels = curve.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "smoothed"))), lambda s: s["smoothed"]).alias("levels"))
        place = F.coalesce((F.col("x") - low) / F.nullif(high - low, F.lit(0.0)) * (grid - 1), F.lit(0.0))
        near = data.withColumn("levels", levels.scalar()).withColumn("place", place).withColumn(
            "step", F.least(F.floor("place"), F.lit(grid - 2)).cast("int"))
        left, right = F.get("levels", F.col("step")), F.get("levels", F.col("step") + 1)
        rest = near.select("x", "y", F.abs(F.col("y") - (left + (right - left) * (F.col("place") - F.col("step")))).alias("rest"))
        typical = quantiles(rest, [], "rest", {"median": 0.5}).select("median").scalar()
        share = F.col("rest") / (6 * F.col("typical"))
        bisquare = F.when(share < 1, F.pow(1 - share * share, F.lit(2))).otherwise(0.0)
        weight = F.when(F.col("rest").isNull(), 1.0).when(F.col("typical") > 0, bisquare).otherwise((F.col("rest") == 0).cast("double"))
        weighed = rest.withColumn("typical", typical).withColumn("weight", weight)
        points = weighed.groupBy("x").agg(F.sum("weight").alias("mass"), F.sum(F.col("weight") * F.col("y")).alias("sy"))
        curve = _local_lines(at_places(points), reaches, "mass")
    return curve.select(F.col("i").alias("grid_place"), F.col("at").alias(x), "smoothed")


def donut(df: DataFrame, name: str, value: str, n: int = TOP_SLICES) -> DataFrame:
    """The ``n`` largest slices and each one's share of what is shown."""
    top = df.select(name, value).orderBy(F.desc_nulls_last(value), F.asc(name)).limit(n)
    shown = Window.partitionBy(F.lit(0))  # at most n rows
    return top.withColumn("share", F.col(value) / F.sum(value).over(shown))


def pie(df: DataFrame, name: str, value: str) -> DataFrame:
    """As :func:`donut`, with the smaller number of slices of the plain pie."""
    return donut(df, name, value, PIE_SLICES)


def hierarchy(df: DataFrame, path: Sequence[str], value: str, color: str | None = None, root: bool = False) -> DataFrame:
    """Totals at each level of a hierarchy, with the value-weighted mean of ``color``.

    The leaves are summed first; only those few rows are repeated for the upper levels.
    """
    weighted = F.col(color) * F.col(value) if color else F.lit(None).cast("double")
    leaves = df.dropna(subset=list(path)).groupBy(*path).agg(F.sum(value).alias("value"), F.sum(weighted).alias("weighted"))
    levels = leaves.rollup(*path).agg(
        F.sum("value").alias("value"), F.sum("weighted").alias("weighted"), F.grouping_id().alias("gid")
    )
    level = F.lit(len(path)) - F.length(F.regexp_replace(F.bin("gid"), "0", ""))
    out = levels.select(
        *path, level.alias("level"), "value",
        *([(F.col("weighted") / F.nullif(F.col("value"), F.lit(0.0))).alias("color")] if color else []),
    )
    return out if root else out.where(F.col("level") > 0)


def rose(df: DataFrame, category: str, value: str) -> DataFrame:
    """Value per category: the radius of its slice."""
    return df.groupBy(category).agg(F.sum(value).alias("radius"))


def scatter(
    df: DataFrame, x: str, y: str, color: str | None = None, size: str | None = None, fraction: float | None = None,
    seed: int = 7,
) -> DataFrame:
    """Points, with optional colour and size (bubbles); ``fraction`` draws a sample of them."""
    points = df.select(*dict.fromkeys(c for c in [x, y, color, size] if c)).dropna(subset=[x, y])
    return points if fraction is None else points.sample(fraction=fraction, seed=seed)


def histogram(df: DataFrame, x: str, bins: int = HISTOGRAM_BINS, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal bins (5 to 100) from the lowest to the highest value, per colour."""
    if not 5 <= bins <= 100:
        raise ValueError("bins must be between 5 and 100")
    data = df.where(F.col(x).isNotNull())
    low, high = _bounds(data, x)
    placed = data.select(*by, F.col(x).cast("double").alias("v"), low.alias("low"), high.alias("high"))
    counts = placed.groupBy(*by, _bin(F.col("v"), F.col("low"), F.col("high"), bins).alias("bin"), "low", "high").agg(
        F.count(F.lit(1)).alias("n")
    )
    step = (F.col("high") - F.col("low")) / bins
    return counts.select(
        *by, "bin", (F.col("low") + F.col("bin") * step).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * step).alias("bin_end"), "n",
    )


def density2d(df: DataFrame, x: str, y: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in a grid, with the margins: (x_bin, y_bin, n), where NULL stands for all bins of that axis."""
    data = df.dropna(subset=[x, y])
    (x0, x1), (y0, y1) = _bounds(data, x), _bounds(data, y)
    placed = data.select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), x0.alias("x0"), x1.alias("x1"),
        y0.alias("y0"), y1.alias("y1"),
    )
    cells = placed.groupBy(
        _bin(F.col("x"), F.col("x0"), F.col("x1"), bins).alias("x_bin"),
        _bin(F.col("y"), F.col("y0"), F.col("y1"), bins).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return cells.cube("x_bin", "y_bin").agg(F.sum("n").alias("n")).where("x_bin IS NOT NULL OR y_bin IS NOT NULL")


def ecdf(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows up to each distinct value, per colour."""
    ranked = cumulative(df, list(by), x)
    return ranked.select(*by, x, "n", ((F.col("before") + F.col("n")) / F.col("total")).alias("share"))


def _fences() -> tuple[Column, Column]:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return F.col("q1") - reach, F.col("q3") + reach


def box(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (farthest values within 1.5 quartile ranges) and number of outliers per category.

    ``df`` is read once, into a stored table of counts per value; NULL and NaN are no values.
    """
    stored = counted(df, list(by), y)
    quarts = quantiles_of(accumulated(stored, list(by), y), list(by), y, BOX_QUANTILES)
    counts = stored.drop("_bucket").withColumnRenamed("n", "k")
    low, high = _fences()
    inside = F.col(y).between(low, high)
    if by:
        joined = null_safe_join(counts, quarts, list(by))
    else:
        joined = counts.select("*", *[quarts.select(c).scalar().alias(c) for c in ["n", *BOX_QUANTILES]])
    return joined.groupBy(*by, "n", *BOX_QUANTILES).agg(
        F.min(F.when(inside, F.col(y))).alias("whisker_low"), F.max(F.when(inside, F.col(y))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("k"))).alias("outliers"),
    )


def box_outliers(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows outside the whiskers."""
    low, high = _fences()
    quarts = quantiles(df, list(by), y, BOX_QUANTILES).drop("n", "median")
    if by:
        joined = null_safe_join(df.where(F.col(y).isNotNull()), quarts, list(by))
    else:
        joined = df.where(F.col(y).isNotNull()).select("*", *[quarts.select(c).scalar().alias(c) for c in ["q1", "q3"]])
    return joined.where(~F.col(y).between(low, high)).drop("q1", "q3")


def violin(df: DataFrame, y: str, by: Sequence[str], grid: int = 50, bins: int = 256) -> DataFrame:
    """Box and density curve per category: quartiles and ``grid`` points of a Gaussian kernel over ``bins`` bins."""
    by = list(by)
    # All figures come from one stored table of counts per value; ``df`` is read once.
    stored = counted(df.select(*by, F.col(y).cast("double").alias("v")), by, "v")
    means = stored.groupBy(*by).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("all"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean")
    )
    apart = null_safe_join(stored, means, by).groupBy(*by, "low", "high", "all").agg(F.sum(F.col("n") * F.pow(F.col("v") - F.col("mean"), F.lit(2))).alias("squares"))
    spread = apart.select(*by, "low", "high", F.coalesce(F.sqrt(F.col("squares") / F.nullif(F.col("all") - 1, F.lit(0))), F.lit(0.0)).alias("sd"))
    facts = null_safe_join(quantiles_of(accumulated(stored, by, "v"), by, "v", BOX_QUANTILES), spread, by)
    iqr = (F.col("q3") - F.col("q1")) / 1.349
    width = F.when(iqr > 0, F.least("sd", iqr)).otherwise(F.col("sd")) * 1.06 * F.pow(F.col("n"), F.lit(-0.2))
    facts = facts.withColumn("h", F.when(width > 0, width).otherwise(1.0))
    low, high = _bounds(stored, "v")
    placed = stored.select(*by, "v", "n", low.alias("l"), high.alias("r"))
    counts = placed.groupBy(*by, _bin(F.col("v"), F.col("l"), F.col("r"), bins).alias("bin")).agg(
        F.sum("n").alias("k"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("centre")
    )
    joined = null_safe_join(counts, facts, by).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("grid_place")
    )
    at = F.col("low") - 2 * F.col("h") + (F.col("high") - F.col("low") + 4 * F.col("h")) * F.col("grid_place") / (grid - 1)
    u = (at - F.col("centre")) / F.col("h")
    bell = F.exp(u * u * -0.5) * F.col("k") / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return joined.groupBy(*by, "n", *BOX_QUANTILES, "grid_place", at.alias("grid_value")).agg(F.sum(bell).alias("density"))


def heatmap(df: DataFrame, x: str, y: str, z: str, out: str = "mean") -> DataFrame:
    """Mean of ``z`` in every cell of the chart, one row per distinct y and x, empty cells 0; a NULL place is none.

    The rows are reduced to cells first. Both axes are tables: the places of x are dealt into ``AXIS_BLOCKS`` blocks by their
    hash, each place of y goes to every block once, and the blocks meet by an equi-join.
    """
    placed = df.dropna(subset=[x, y])
    cells = placed.groupBy(y, x).agg(F.avg(z).alias("_mean"))
    axis = placed.select(x).distinct().withColumn("_block", F.pmod(F.xxhash64(x), F.lit(AXIS_BLOCKS)).cast("int"))
    lines = placed.select(y).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(AXIS_BLOCKS - 1))))
    grid = lines.join(axis, "_block").drop("_block")
    return grid.join(cells, [y, x], "left").select(y, x, F.coalesce("_mean", F.lit(0.0)).alias(out))


def radar(df: DataFrame, item: str, items: Sequence, metrics: Sequence[str], normalise: bool = True) -> DataFrame:
    """Chosen items by metric, each metric stretched to 0..100 over the chosen items; 0 where they are all equal."""
    chosen = df.where(F.col(item).isin(list(items))).select(item, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = chosen.unpivot([item], list(metrics), "metric", "raw_value")
    if not normalise:
        return long.withColumn("shown", F.col("raw_value"))
    ends = long.groupBy("metric").agg(F.min("raw_value").alias("low"), F.max("raw_value").alias("high"))
    range_ = F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    return long.join(ends, "metric").select(
        item, "metric", "raw_value", F.coalesce((F.col("raw_value") - F.col("low")) / range_ * 100, F.lit(0.0)).alias("shown")
    )


def sankey(df: DataFrame, source: str, target: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Node list (node_id from 0, label) and links by node number."""
    ends = df.select(F.explode(F.array_distinct(F.array(source, target))).alias("label"))
    nodes = assign_key(ends, ["label"], "node_id").withColumn("node_id", F.col("node_id") - 1)
    links = (
        df.join(nodes.select(F.col("label").alias(source), F.col("node_id").alias("source_id")), source)
        .join(nodes.select(F.col("label").alias(target), F.col("node_id").alias("target_id")), target)
        .select("source_id", "target_id", value)
    )
    return nodes, links


def funnel(df: DataFrame, stage: str, value: str, stages: Sequence[str]) -> DataFrame:
    """Totals of the given stages in order, with the ratio to the stage before."""
    place = F.create_map(*[F.lit(v) for i, s in enumerate(stages) for v in (s, i + 1)])
    totals = df.where(F.col(stage).isin(list(stages))).groupBy(stage).agg(F.sum(value).alias("total"))
    steps = Window.partitionBy(F.lit(0)).orderBy("place")  # one row per given stage
    return totals.withColumn("place", place[F.col(stage)]).withColumn(
        "step_ratio", F.col("total") / F.nullif(F.lag("total").over(steps), F.lit(0.0))
    )
