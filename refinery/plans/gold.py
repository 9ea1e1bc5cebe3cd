"""Gold KPIs of the sales pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.dates import as_date
from refinery.functions.money import cents, from_cents, mean_cents
from refinery.functions.stamps import now_or

# The column names of the Gold KPI table contract.
KPI_COLUMNS = ["fecha", "categoria", "canal", "num_ventas", "unidades",
               "importe_total", "ticket_medio"]


def compute_kpis(sales: DataFrame, date: str = "fecha", category: str = "categoria",
                 channel: str = "canal", quantity: str = "cantidad", amount: str = "importe",
                 stamp: dt.datetime | None = None, stamp_col: str = "_generated_at") -> DataFrame:
    """A1: daily KPIs per category and channel.

    ``fecha`` becomes a DATE here (text until Gold; bad text gives NULL rather
    than failing the job). Sums are exact: amounts in integer cents, the
    average rounded half up to the cent. One partial + final hash aggregate.
    """
    return (
        sales.select(as_date(sales, date).alias("fecha"),
                     F.col(category).alias("categoria"), F.col(channel).alias("canal"),
                     F.col(quantity).alias("_q"), cents(amount).alias("_c"))
        .groupBy("fecha", "categoria", "canal")
        .agg(F.count(F.lit(1)).alias("num_ventas"),
             F.sum("_q").cast("long").alias("unidades"),
             F.sum("_c").alias("_sum_c"))
        .select("fecha", "categoria", "canal", "num_ventas", "unidades",
                from_cents("_sum_c").alias("importe_total"),
                mean_cents("_sum_c", "num_ventas").alias("ticket_medio"))
        .withColumn(stamp_col, now_or(stamp))
    )
