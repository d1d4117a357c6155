"""Mixing sources to target weights by Poisson replication, with Spark expressions only.

Each source gets a repetition rate: its target share of the budget over its own size. Each document draws how often it is
repeated from a Poisson distribution with that rate, by inverting the distribution at a number hashed from its id and a
seed, so the draw is the same on every run and every retry. Copies are then shuffled globally by a hashed key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.columns import set_aside

SEED = 17
ALPHA = 0.5
SALTS = 32


def _hashed(*parts: Column) -> Column:
    """52 hashed bits of ``parts`` as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = ALPHA, budget: float = 1.0) -> DataFrame:
    """Per source: ``source``, ``source_chars`` and ``rate``, the mean number of copies of each of its documents.

    ``weights`` gives target weights by source (a source not named gets none and is left out of the mixture); without
    them the target weight is the source's size to the power ``alpha``. ``budget`` is the size of the mixture as a
    multiple of the size of the sources taking part. NULL sources count as one source; empty texts weigh nothing.
    """
    sizes = docs.groupBy("source").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("source_chars"))
    weight = F.pow(F.col("source_chars").cast("double"), F.lit(alpha))
    if weights is not None:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]) if weights else None
        weight = F.coalesce(named[F.col("source")], F.lit(0.0)) if weights else F.lit(0.0)
    weighted = sizes.select("source", "source_chars", F.when(F.col("source_chars") > 0, weight).otherwise(0.0).alias("weight"))
    total = weighted.where("weight > 0").agg(F.sum("weight").alias("all_weight"), F.sum("source_chars").alias("all_chars"))
    wanted = F.lit(budget) * F.col("all_chars") * F.col("weight") / F.col("all_weight")
    # One row of totals: joined on a constant key.
    return (
        weighted.withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one", "left")
        .select("source", "source_chars", F.when(F.col("weight") > 0, wanted / F.col("source_chars")).otherwise(F.lit(0.0)).alias("rate"))
    )


def poisson_steps(rates: DataFrame) -> DataFrame:
    """Add ``steps``: the cumulative Poisson probabilities of 0, 1, 2, ... copies, as far as a double can tell from 1.

    Probabilities are summed in logarithms, so that large rates do not underflow.
    """
    by_rate = rates.select("rate").where("rate > 0").distinct()
    highest = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = by_rate.select("rate", F.explode(F.sequence(F.lit(0), highest)).alias("k"))
    upto = Window.partitionBy("rate").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # ln k! as a running sum of ln k.
    logs = terms.withColumn("log_factorial", F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(upto))
    chance = F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_factorial"))
    summed = logs.withColumn("upto", F.sum(chance).over(upto))
    steps = summed.groupBy("rate").agg(F.array_sort(F.collect_list("upto")).alias("steps"))
    return rates.join(steps, "rate", "left")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = ALPHA, budget: float = 1.0, seed: int = SEED) -> DataFrame:
    """The mixture: all columns of ``docs`` and ``copies`` (how often the document is repeated), ``copy`` (1, 2, ...),
    ``shuffle_key``; rows are dealt over the partitions by the key and sorted by it.

    Documents with NULL or empty text, or of a source without weight, are not repeated even once when their source's
    rate is 0; otherwise they are drawn like the rest. Rows that repeat a doc_id draw the same number. A NULL doc_id
    draws as an empty one. Extra columns are carried along; ``copies``, ``copy`` and ``shuffle_key`` are replaced.

    The rates are joined on source and a salt, each source's rates once per salt, so that no source is one join key.
    """
    docs, given = set_aside(docs.drop("copies", "copy", "shuffle_key"), ("doc_id", "source", "text"))
    kept = [f"`{c}`" for c in docs.columns]
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = docs.select(
        *kept, F.coalesce("source", F.lit("")).alias("_source"), F.isnull("source").alias("_none"),
        _hashed(doc_id, F.lit(str(seed))).alias("_draw"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("_salt"),
    )
    steps = poisson_steps(source_rates(docs, weights, alpha, budget)).where("rate > 0").select(
        F.coalesce("source", F.lit("")).alias("_source"), F.isnull("source").alias("_none"), F.col("steps").alias("_steps"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"),
    )
    counted = drawn.join(steps, ["_source", "_none", "_salt"]).select(
        *kept, F.size(F.filter("_steps", lambda p: p <= F.col("_draw"))).alias("copies"),
    )
    copies = counted.where("copies > 0").select(*kept, "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", doc_id, F.col("copy"), F.lit(f"order {seed}")).cast("binary")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key").select(*given, "copies", "copy", "shuffle_key")
