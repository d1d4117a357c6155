"""Column helpers for exact arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """``scale * num / den`` of whole numbers, rounded half up to ``digits``; NULL when ``den`` is zero.

    All in long arithmetic, so the result does not depend on how a double happened to round.
    """
    unit = 10**digits
    n = num.cast("long") * F.lit(2 * scale * unit)
    d = F.nullif(den.cast("long"), F.lit(0).cast("long"))
    return whole_div(n + d, d * 2) / F.lit(float(unit))


def whole_div(a: Column, b: Column) -> Column:
    """Integer division, as SQL's ``a div b``."""
    return F.call_function("div", a, b)


def magnitude_bucket(value: Column, per_octave: int = 32) -> Column:
    """A whole number that grows with ``value``: ``per_octave`` steps for every doubling of its size.

    There are at most ``2 * 1024 * per_octave + 1`` buckets whatever the data, and a few far-out values do not
    squeeze all the others into one bucket, as equal-width buckets would let them.
    """
    v = value.cast("double")
    step = F.floor(F.log2(F.lit(1.0) + F.abs(v)) * F.lit(float(per_octave)))
    return F.when(v < 0, -step - 1).otherwise(step)


def hash_bucket(*keys: Column, digits: int = 3) -> Column:
    """The first ``digits`` hex digits of the md5 of the keys: ``16 ** digits`` even buckets, the same everywhere."""
    return F.substring(F.md5(F.concat_ws("\x1f", *[k.cast("string") for k in keys])), 1, digits)
