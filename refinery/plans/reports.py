"""Consumption queries over Gold (A7-A12, P5, O1, C3), as DataFrame plans.

Money is summed in integer cents and averaged half up (H1), so the totals do
not depend on partitioning. ``ticket_mean`` returns both the average of the
group averages as the dashboard writes it and the weighted average (H10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.money import cents, from_cents, mean_cents


def _money_sum(col: str, alias: str):
    return from_cents(F.sum(cents(col))).alias(alias)


# ---- sales KPIs ----------------------------------------------------------
def revenue_total(kpis: DataFrame) -> DataFrame:
    """SUM(importe_total)."""
    return kpis.agg(_money_sum("importe_total", "revenue_total"))


def units_total(kpis: DataFrame) -> DataFrame:
    """SUM(unidades)."""
    return kpis.agg(F.sum("unidades").cast("long").alias("units_total"))


def ticket_mean(kpis: DataFrame) -> DataFrame:
    """AVG(ticket_medio) unweighted, and the weighted sum/count average."""
    return kpis.agg(
        mean_cents(F.sum(cents("ticket_medio")), F.count("ticket_medio")).alias("ticket_mean"),
        mean_cents(F.sum(cents("importe_total")), F.sum("num_ventas")).alias("ticket_weighted"))


def revenue_by(kpis: DataFrame, key: str) -> DataFrame:
    """Revenue per day, category or channel."""
    return kpis.groupBy(key).agg(_money_sum("importe_total", "importe_total"))


def kpi_detail(kpis: DataFrame) -> DataFrame:
    """P5: the KPI detail table."""
    return kpis.select("fecha", "categoria", "canal", "num_ventas", "unidades",
                       "importe_total", "ticket_medio")


def kpi_filtered(kpis: DataFrame, predicate: str) -> DataFrame:
    """A SQL-string predicate."""
    return kpi_detail(kpis).filter(predicate)


# ---- change-feed orders --------------------------------------------------
def control_counters(control: DataFrame) -> DataFrame:
    """MAX(ultima_version), MAX(filas_procesadas)."""
    return control.agg(F.max("ultima_version").alias("ultima_version"),
                       F.max("filas_procesadas").alias("filas_procesadas"))


def orders_in_force(agg: DataFrame) -> DataFrame:
    """A10: SUM(num_pedidos)."""
    return agg.agg(F.sum("num_pedidos").cast("long").alias("orders_in_force"))


def orders_by_state(agg: DataFrame, group: str) -> DataFrame:
    """A10: orders per state."""
    return agg.groupBy(group).agg(F.sum("num_pedidos").cast("long").alias("num_pedidos"))


def revenue_by_state(agg: DataFrame, group: str) -> DataFrame:
    """A10: revenue per state."""
    return agg.groupBy(group).agg(_money_sum("importe_total", "importe_total"))


def orders_by_city(table: DataFrame, city: str) -> DataFrame:
    """COUNT(*) per city over the source table."""
    return table.groupBy(city).agg(F.count(F.lit(1)).alias("num_pedidos"))


def recalc_order(agg: DataFrame, group: str) -> DataFrame:
    """O1: groups by recalculation time, newest first."""
    return (agg.select(group, "num_pedidos",
                       F.col("_recalculado_at").cast("timestamp_ntz").alias("_recalculado_at"))
            .orderBy(F.col("_recalculado_at").desc(), F.col(group)))


# ---- CDC customers -------------------------------------------------------
def customer_gold(customers: DataFrame, segment: str = "c_mktsegment") -> DataFrame:
    """Active and deleted customers and the active balance, per segment.

    Balances can be negative, so they are summed in cents and not averaged.
    """
    active = ~F.coalesce(F.col("is_deleted"), F.lit(False))
    return customers.groupBy(segment).agg(
        F.count_if(active).alias("active_customers"),
        F.count_if(~active).alias("deleted_customers"),
        from_cents(F.coalesce(F.sum(F.when(active, cents("c_acctbal"))), F.lit(0)))
        .alias("active_balance"))
