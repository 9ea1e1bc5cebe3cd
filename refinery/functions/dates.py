"""Date parsing that never fails the job (ANSI mode raises on bad text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType


def as_date(df: DataFrame, col: str) -> Column:
    """Text or timestamp column to DATE; malformed text gives NULL."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, DateType):
        return F.col(col)
    if isinstance(dtype, StringType):
        return F.try_to_date(F.col(col))
    return F.to_date(F.col(col))
