"""Exact money arithmetic.

``round(sum(double), 2)`` and ``round(avg(double), 2)`` depend on the order in
which partial sums meet, which changes with partitioning. Amounts here carry
two decimals, so they are summed as integer cents (exact, order free) and
turned back into doubles once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col) -> Column:
    """Amount in whole cents (half away from zero) as bigint."""
    return F.round(_c(col) * 100).cast("long")


def from_cents(col) -> Column:
    """Cents back to a double amount."""
    return _c(col).cast("double") / 100


def half_up_div(num, den) -> Column:
    """``num / den`` rounded half up (ties away from zero), in whole numbers; NULL unless den > 0.

    Exact for every bigint: the doubled numerator is a decimal, never a double.
    """
    n, d = _c(num).cast("decimal(20,0)"), _c(den).cast("decimal(20,0)")
    up = F.call_function("div", F.abs(n) * 2 + d, F.when(d > 0, d * 2))
    return F.when(n < 0, -up).otherwise(up).cast("long")


def mean_cents(sum_cents, count) -> Column:
    """Average amount, rounded half up to the cent, as a double."""
    return from_cents(half_up_div(sum_cents, count))


def round_money(col, scale: int = 2) -> Column:
    """X2 for single values (not sums): half-up round of a double."""
    return F.round(_c(col), scale)
