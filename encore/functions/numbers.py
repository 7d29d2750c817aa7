"""Numeric helpers shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half up on the decimal value, so that double noise cannot move a result across a tie."""
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, null for a zero whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def lookup(value: Column, table: dict, default=None) -> Column:
    """Literal map lookup as a CASE expression."""
    expr = None
    for key, mapped in table.items():
        hit = value == F.lit(key)
        expr = F.when(hit, F.lit(mapped)) if expr is None else expr.when(hit, F.lit(mapped))
    return expr.otherwise(F.lit(default) if not isinstance(default, Column) else default)
