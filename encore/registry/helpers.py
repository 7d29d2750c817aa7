"""Shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.numbers import half_up

AS_OF = "2001-08-01"
UPCOMING = "2000-01-01"
EVENTS_AS_OF = "2024-01-31"


def tidy(df: DataFrame, digits: int = 4, **per_column: int) -> DataFrame:
    """Round doubles half up and widen integers, so that both engines print the same values."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = half_up(col, per_column.get(field.name, digits))
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.concat_ws("|", col)
        columns.append(col.alias(field.name))
    return df.select(*columns)
