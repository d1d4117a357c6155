"""Keeping a table's further columns apart from those an operator works with."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, kept: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``kept`` renamed to ``further_0``, ``further_1``, ..., and what gives back the old names in order.

    No operator uses such names, so a further column may have any name.
    """
    kept = set(kept)
    held = [c if c in kept else f"further_{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*held), [F.col(f"`{h}`").alias(c) for h, c in zip(held, docs.columns)]
