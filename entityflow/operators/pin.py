"""Evaluate an expression once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is evaluated exactly once per row.

    A filter or projection on a plain computed column has the expression
    copied into it, once per mention; for a parser of many branches that
    multiplies the work and makes the generated code too large to compile.
    Exploding a one-element array stays a step of its own: one row in, one
    row out, still generated code, no shuffle. Filters on other columns are
    pushed below it as usual.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*[F.col(f"`{c}`") for c in others], F.explode(F.array(value)).alias(name))
