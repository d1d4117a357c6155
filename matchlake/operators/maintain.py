"""Table maintenance: upserts, keys, corrections and audits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.ranking import null_safe_join, number_by_hash, running_totals
from matchlake.session import cut_lineage


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by ``order``.

    An aggregation, not a window: every task keeps one row per key before the shuffle, so a key with very many
    copies costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, each column with its last value that is not NULL by ``order`` (the largest value where that ties).

    ``order`` is left out of the result; keys that are NULL share a row.
    """
    rest = [c for c in df.columns if c not in [*keys, *order]]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_value")))).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*last) if last else df.select(*keys).distinct()


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Insert ``source`` into ``target``; ``source`` is unique on ``keys`` (see :func:`dedupe`).

    On a key that exists: "overwrite" replaces the columns that ``source`` has, "ignore" keeps the old row, "coalesce"
    takes the new value where there is one.
    """
    keys = list(keys)
    if mode == "ignore":
        return target.unionByName(source.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    if mode == "overwrite" and set(source.columns) == set(target.columns):
        return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
    if mode not in ("overwrite", "coalesce"):
        raise ValueError(f"unknown mode {mode!r}")
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in source.columns if c not in keys])
    joined = target.join(new.withColumn("_given", F.lit(True)), keys, "full_outer")

    def merged(c: str) -> Column:
        if c in keys or f"_new_{c}" not in new.columns:
            return F.col(c)
        if mode == "coalesce":
            return F.coalesce(f"_new_{c}", c).alias(c)
        return F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in target.columns])


def assign_key(
    df: DataFrame, natural: Sequence[str], key: str, existing: DataFrame | None = None
) -> DataFrame:
    """Dense whole-number keys for the distinct ``natural`` values; in all columns but the first NULL is a value like others.

    Keys already given in ``existing`` (natural..., key) never change; new values go on after the highest one. The
    numbering runs over hash buckets, so that no task sorts all values. The distinct values are written to the shared
    checkpoint folder first: they are needed twice, and ``df`` may be long to read.
    """
    natural = list(natural)
    values = df.select(*natural).where(F.col(natural[0]).isNotNull()).distinct()
    if existing is None:
        return number_by_hash(cut_lineage(values), natural, key)
    unknown = cut_lineage(null_safe_join(values, existing.select(*natural), natural, "left_anti"))
    new = number_by_hash(unknown, natural, key)
    last = existing.agg(F.coalesce(F.max(key), F.lit(0).cast("long")).alias("last")).scalar()
    return existing.select(*natural, F.col(key).cast("long").alias(key)).unionByName(
        new.withColumn(key, F.col(key) + last)
    )


# What a match needs keys for: a count column, and the column with the last key before its own.
KEY_RANGES = {"n_innings": "before_innings", "n_balls": "before_balls", "n_wickets": "before_wickets"}
_RANGE_BUCKET = 1 << 16


def _continued(numbered: DataFrame) -> DataFrame:
    """Add the key ranges of matches in order of match_no, without gaps, from 1."""
    amounts = {before: F.col(count).cast("long") for count, before in KEY_RANGES.items()}
    return running_totals(numbered, [], F.floor(F.col("match_no") / _RANGE_BUCKET), [F.col("match_no")], amounts)


def assign_ranges(numbered: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``match_id``, ``match_no`` and the counts of ``KEY_RANGES``, with the range of keys of each match.

    A running total over the matches, so a key is one addition to a place in the match's own row and has no limit but
    that of a long. Ranges in ``existing`` (the same columns, of an earlier load) stay as long as a match has room in its
    own; a match that has grown out of it gets a new one behind all others, as new matches do.
    """
    numbered = numbered.select("match_id", "match_no", *KEY_RANGES)
    if existing is None or not set(KEY_RANGES.values()) <= set(existing.columns):
        return _continued(numbered)
    old = existing.select("match_id", *[F.col(c).alias(f"_old_{c}") for c in [*KEY_RANGES, *KEY_RANGES.values()]])
    fits = F.lit(True)
    for count in KEY_RANGES:
        fits = fits & (F.col(count) <= F.col(f"_old_{count}"))
    placed = numbered.join(old, "match_id", "left").withColumn("_fits", F.coalesce(fits, F.lit(False)))
    kept = placed.where("_fits").select("match_id", "match_no", *[F.col(f"_old_{c}").alias(c) for c in [*KEY_RANGES, *KEY_RANGES.values()]])
    new = _continued(placed.where("NOT _fits").select("match_id", "match_no", *KEY_RANGES))
    for count, before in KEY_RANGES.items():
        last = existing.agg(F.coalesce(F.max(F.col(before) + F.col(count)), F.lit(0).cast("long")).alias("last")).scalar()
        new = new.withColumn(before, F.col(before) + last)
    return kept.unionByName(new)


def attach_key(df: DataFrame, dim: DataFrame, on: dict[str, str], key: str, out: str) -> DataFrame:
    """Look up ``key`` in ``dim`` by name; NULL where the name is unknown. ``on`` maps columns of df to columns of dim."""
    side = dim.select(*[F.col(d).alias(f"_k_{d}") for d in on.values()], F.col(key).alias(f"_v_{out}"))
    condition = F.lit(True)
    for left, right in on.items():
        condition = condition & (df[left] == side[f"_k_{right}"])
    columns = [df[c] for c in df.columns if c != out]
    return df.join(side, condition, "left").select(*columns, F.col(f"_v_{out}").alias(out))


def apply_corrections(df: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Overwrite single attributes by curated values; a NULL in a patch leaves the attribute alone.

    Of several patches for a key, each attribute's largest value counts.
    """
    columns = [c for c in patches.columns if c != key]
    renamed = latest_values(patches, [key]).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_fix_{c}") for c in columns])
    joined = df.join(renamed, df[key] == renamed["_key"], "left")
    return joined.select(
        *[F.coalesce(F.col(f"_fix_{c}").cast(df.schema[c].dataType), df[c]).alias(c) if c in columns else df[c]
          for c in df.columns]
    )


def drop_whole(df: DataFrame, bad: DataFrame, group: str) -> DataFrame:
    """Remove every row of a group that has any bad row."""
    return df.join(bad.select(group).distinct(), group, "left_anti")


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    """A condition in SQL text; NULL counts as met, as in a table constraint."""

    table: str
    name: str
    condition: str


@dataclass(frozen=True)
class ForeignKey:
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _found(df: DataFrame, rule: str, table: str, key: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), key.alias("key"), F.col("n"))


def audit(tables: dict[str, DataFrame], rules: Sequence) -> DataFrame:
    """Violations as rows (rule, table_name, key, n): one per broken key, or one per column or condition.

    Keys are counted before they are compared with their parents, so the join only sees distinct keys. It is always a merge
    of both sides: the planner takes a few columns of a compressed file for small, and would have the driver hold the keys
    of a large parent table. The row-wise rules of one table share one pass over it.
    """
    found = []
    by_table: dict[str, list] = {}
    for rule in rules:
        if isinstance(rule, (NotNull, Check)):
            by_table.setdefault(rule.table, []).append(rule)
        elif isinstance(rule, Unique):
            # As in SQL, a key with a NULL in it equals no other.
            whole = tables[rule.table].dropna(subset=list(rule.columns))
            counts = whole.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            found.append(_found(counts, "unique " + ",".join(rule.columns), rule.table, _key_text(rule.columns)))
        else:
            counts = tables[rule.table].dropna(subset=list(rule.columns)).groupBy(*rule.columns).agg(
                F.count(F.lit(1)).alias("n")
            )
            parent = tables[rule.parent].select(*[F.col(p).alias(f"_p_{p}") for p in rule.parent_columns])
            condition = F.lit(True)
            for c, p in zip(rule.columns, rule.parent_columns):
                condition = condition & (F.col(c) == F.col(f"_p_{p}"))
            orphans = counts.join(parent.hint("merge"), condition, "left_anti")
            found.append(_found(orphans, f"in {rule.parent}", rule.table, _key_text(rule.columns)))
    for table, checks in by_table.items():
        counts, names = [], []
        for i, rule in enumerate(checks):
            broken = F.col(rule.column).isNull() if isinstance(rule, NotNull) else ~F.coalesce(
                F.expr(rule.condition), F.lit(True)
            )
            counts.append(F.coalesce(F.sum(broken.cast("long")), F.lit(0).cast("long")).alias(f"c{i}"))
            names.append(f"not null {rule.column}" if isinstance(rule, NotNull) else f"check {rule.name}")
        row = tables[table].agg(*counts)
        pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("rule"), F.col(f"c{i}").alias("n")) for i, x in enumerate(names)]))
        broken = row.select(pairs.alias("p")).select("p.*").where("n > 0")
        found.append(broken.select("rule", F.lit(table).alias("table_name"), F.lit(None).cast("string").alias("key"), "n"))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
