"""Column profiles of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _comparable(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.AtomicType) and not isinstance(field.dataType, (T.BinaryType, T.VariantType))


def _shown(value: Column, field: T.StructField) -> Column:
    """As text; 0.0 and -0.0 are the same lowest value."""
    plain = value + F.lit(0.0) if isinstance(field.dataType, T.FractionalType) else value
    return plain.cast("string")


def profile(tables: dict[str, DataFrame], order: dict[str, Sequence[str]], ignore: Sequence[str] = ()) -> DataFrame:
    """Per table and column: type, comment, rows, NULLs, lowest, highest and three sample values.

    One aggregation per table. The samples are those of the three first rows by ``order`` (all columns if none is
    given); columns that are neither text nor number nor time get no values. The three first keys are looked up at once,
    from the key columns alone; their rows are then read by those keys, so no long text goes through a sort.
    """
    result = None
    for name, df in tables.items():
        if name in ignore:
            continue
        fields = df.schema.fields
        sums = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count(f.name).alias(f"c{i}") for i, f in enumerate(fields)],
            *[F.struct(_shown(F.min(f.name), f).alias("low"), _shown(F.max(f.name), f).alias("high")).alias(f"m{i}")
              for i, f in enumerate(fields) if _comparable(f)],
        )
        first = order.get(name) or [f.name for f in fields if _comparable(f)]
        keys = [F.col(c) for c in first]
        theirs = F.lit(False)
        for key in df.select(*keys).orderBy(*[k.asc() for k in keys]).limit(3).collect():
            same = F.lit(True)
            for c in first:
                same = same & F.col(c).eqNullSafe(F.lit(key[c]).cast(df.schema[c].dataType))
            theirs = theirs | same
        # Three rows: the collected lists below hold three values each.
        top = df.where(theirs).orderBy(*[F.asc(c) for c in first]).limit(3).select(
            F.struct(*[F.col(c) for c in first]).alias("_k"),
            *[F.col(f.name).cast("string").alias(f"s{i}") for i, f in enumerate(fields) if _comparable(f)],
        )
        samples = top.agg(
            F.struct(
                *[F.array_sort(F.collect_list(F.struct("_k", f"s{i}"))).getField(f"s{i}").alias(f"v{i}")
                  for i, f in enumerate(fields) if _comparable(f)]
            ).alias("v")
        )
        both = sums.withColumn("v", samples.scalar())
        text, texts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
        rows = F.array(*[
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.metadata.get("comment")).cast("string").alias("comment"), "n_rows",
                (F.col("n_rows") - F.col(f"c{i}")).alias("n_nulls"),
                (F.col(f"m{i}.low") if _comparable(f) else text).alias("low"),
                (F.col(f"m{i}.high") if _comparable(f) else text).alias("high"),
                (F.col(f"v.v{i}") if _comparable(f) else texts).alias("samples"),
            )
            for i, f in enumerate(fields)
        ])
        one = both.select(F.lit(name).alias("table_name"), F.explode(rows).alias("r")).select("table_name", "r.*")
        result = one if result is None else result.unionByName(one)
    return result
