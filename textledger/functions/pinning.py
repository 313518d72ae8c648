"""Evaluate an expression once, however often it is used above."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a one-row ``inline``.

    A filter on a projected column is pushed below the projection with the whole
    expression copied into it, and a condition over N keywords then evaluates its
    input N times.  Predicates on the output of a generator are not pushed
    through it, so the value is computed once.  The generator emits exactly one
    row per row, runs inside whole-stage codegen and needs no shuffle.
    """
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
