"""Column expressions (built-in Spark functions only, no UDFs)."""

from refinery.functions.money import (
    cents, from_cents, half_up_div, mean_cents, round_money,
)
from refinery.functions.dates import as_date
from refinery.functions.stamps import now_or, with_stamp

__all__ = [
    "cents", "from_cents", "half_up_div", "mean_cents", "round_money",
    "as_date", "now_or", "with_stamp",
]
