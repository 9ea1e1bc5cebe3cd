"""Data-quality checks as DataFrame operators (Q1-Q4, Q6; Q5 lives in contracts).

Each check returns the offending rows (or counts) as a DataFrame, so it runs
distributed and can be written, counted or used as a gate before a write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions.money import cents

# The order lifecycle of the change-feed use case. An order only
# moves forward or is cancelled; delivered and cancelled are final.
ORDER_LIFECYCLE = {
    "nuevo": ["pagado", "cancelado"],
    "pagado": ["enviado", "cancelado"],
    "enviado": ["entregado"],
    "entregado": [],
    "cancelado": [],
}


def transitions_frame(spark: SparkSession, transitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """The allowed (from, to) pairs; a fixed, tiny table."""
    pairs = [(a, b) for a, bs in transitions.items() for b in bs]
    return spark.createDataFrame(pairs, "_from string, _to string")


def previous_state(updates: DataFrame, current: DataFrame, keys: Sequence[str],
                   state_col: str) -> DataFrame:
    """Each update with the state its key has now (``from_state``).

    The table is the streamed side; cached updates of known size are broadcast when
    they are small, so the table is not shuffled.
    """
    now = current.select(*keys, F.col(state_col).alias("from_state"))
    return now.join(updates, list(keys), "inner")


def transition_violations(updates: DataFrame, current: DataFrame, keys: Sequence[str],
                          state_col: str, transitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q1: updates whose (state now -> new state) is not an allowed transition.

    The transition table has a fixed size, so it is broadcast.
    """
    allowed = F.broadcast(transitions_frame(updates.sparkSession, transitions))
    pairs = (previous_state(updates, current, keys, state_col)
             .select(*keys, "from_state", F.col(state_col).alias("to_state")))
    cond = (pairs["from_state"] == allowed["_from"]) & (pairs["to_state"] == allowed["_to"])
    return pairs.join(allowed, cond, "left_anti")


def amount_violations(df: DataFrame, keys: Sequence[str], quantity: str, price_cents: Column,
                      amount: str, tolerance_cents: int = 1) -> DataFrame:
    """Rows where amount differs from quantity x unit price by a cent or more.

    All in integer cents, so the check does not depend on float rounding.
    """
    return (df.select(*keys, F.col(quantity).cast("long").alias("quantity"),
                      price_cents.alias("unit_price_cents"), cents(amount).alias("amount_cents"))
              .withColumn("expected_cents", F.col("quantity") * F.col("unit_price_cents"))
              .withColumn("diff_cents", F.col("amount_cents") - F.col("expected_cents"))
              .where(F.abs("diff_cents") >= tolerance_cents))


def batch_conflicts(inserts: DataFrame, updates: DataFrame, deletes: DataFrame,
                    existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys both updated and deleted in a batch; inserts that reuse a key.

    The reuse check streams the table's keys (unique) against the insert keys.
    """
    k = list(keys)
    both = (updates.select(*k).join(deletes.select(*k), k, "left_semi")
            .withColumn("conflict", F.lit("update_and_delete")))
    reuse = (existing.select(*k).join(inserts.select(*k), k, "left_semi")
             .withColumn("conflict", F.lit("insert_existing_key")))
    return both.unionByName(reuse)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: keys seen more than once, with their count (partial aggregate per key)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1))


def reemission_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: rows, distinct keys and re-emitted rows (rows - keys), in one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       (F.sum("copies") - F.count(F.lit(1))).alias("reemitted"))


def layer_counts(layers: Mapping[str, DataFrame | int]) -> DataFrame:
    """U1 + A12 (Q6): rows per layer, as a union of counts re-aggregated by layer.

    A layer is a frame, which is counted, or a number that its commit row already holds."""
    spark = next(x for x in layers.values() if isinstance(x, DataFrame)).sparkSession
    parts = [(spark.range(1).select(F.lit(x).cast("long").alias("filas")) if isinstance(x, int)
              else x.agg(F.count(F.lit(1)).alias("filas"))).withColumn("capa", F.lit(name))
             for name, x in layers.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("capa").agg(F.sum("filas").cast("long").alias("filas"))
