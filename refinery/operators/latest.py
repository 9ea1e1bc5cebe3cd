"""Keep the latest row per key.

``row_number() = 1`` over ``partitionBy(keys).orderBy(order desc...)``. Spark
plans this as a partial ``WindowGroupLimit`` before the shuffle and a final one
after it, so a key re-emitted millions of times (a hot key holding a third of
the rows) is cut to one row per map partition before anything moves.

The order must be total, or "the latest" is arbitrary (H2): the caller's
ordering columns come first, then every remaining column as a tie breaker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _sortable(kind) -> bool:
    """Spark sorts everything but maps, also inside arrays and structs."""
    if isinstance(kind, MapType):
        return False
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return True


def order_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """The columns of the whole order: ``order`` first, then all others that can be sorted."""
    return list(order) + [c for c in df.columns
                          if c not in keys and c not in order and _sortable(df.schema[c].dataType)]


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list:
    """Descending sort expressions: ``order`` first, then all other columns."""
    return [F.col(c).desc_nulls_last() for c in order_columns(df, keys, order)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` (ties broken by all columns)."""
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))
