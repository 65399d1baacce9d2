"""Evaluate an expression once inside higher-order functions.

Common-subexpression elimination does not reach into lambdas, where a repeated
expression is computed at every mention and for every element. Binding it to a
lambda variable computes it once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read but do not recompute: a filter on a
    projected expression is pushed below it and evaluates it again, one on a
    generated row is not."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).select(*(df.columns if name in df.columns else [*others, name]))
