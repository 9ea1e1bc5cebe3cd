"""The change-feed use case: a Silver orders table with a feed and its Gold aggregate.

``apply_batch`` is E4/K8 (inserts, updates, deletes; each its own commit),
``propagate`` is E5/F3 (see :mod:`refinery.operators.incremental`).
"""

from __future__ import annotations

from dataclasses import dataclass
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from refinery.functions.stamps import with_stamp
from refinery.operators import incremental as inc
from refinery.plans import roles as R
from refinery.sources.tables import VersionedTable

BASE_STAMP = dt.datetime(2024, 1, 1)


def stamp_at(step: int) -> dt.datetime:
    """Deterministic stamps for reproducible runs: BASE_STAMP + step hours."""
    return BASE_STAMP + dt.timedelta(hours=step)


@dataclass
class OrdersCase:
    spark: SparkSession
    root: str

    def __post_init__(self):
        self.source = VersionedTable(self.spark, f"{self.root}/silver/cdf/pedidos",
                                     contract=R.SILVER_ORDERS)
        self.gold = VersionedTable(self.spark, f"{self.root}/gold/cdf/pedidos_agregado",
                                   contract=R.GOLD_ORDERS)
        self.control = VersionedTable(self.spark, f"{self.root}/gold/cdf/cdf_control",
                                      contract=R.CONTROL)
        self.dataset = R.SILVER_ORDERS.full_name

    def seed(self, rows: DataFrame, stamp: dt.datetime | None = None) -> int:
        """First load: version 0 of the source table."""
        return self.source.overwrite(with_stamp(rows, "_updated_at", stamp), "CREATE", stamp)

    def apply_batch(self, batch: dict[str, DataFrame], stamp: dt.datetime | None = None,
                    single_commit: bool = True) -> list[int]:
        """K8: inserts (upsert, so a repeated batch does not duplicate keys), updates
        (upsert), deletes (by key frame), as one version: one rewrite of the table. An
        update of a key that is also inserted wins, a delete wins over both.
        ``single_commit=False`` makes three versions in this order; empty parts are
        skipped."""
        if single_commit:
            parts = [batch[p] for p in ("inserts", "updates") if batch.get(p) is not None]
            ups = parts[-1] if parts else None
            if len(parts) == 2:     # updates win over inserts of the same key
                ups = ups.unionByName(parts[0].join(ups.select(*self.source.keys), self.source.keys, "left_anti"))
            before = self.source.known_version()
            v = self.source.apply(with_stamp(ups, "_updated_at", stamp) if ups is not None else None,
                                  batch.get("deletes"), stamp=stamp)
            return [v] if v != before else []
        versions = []
        for part in ("inserts", "updates"):
            df = batch.get(part)
            if df is not None:
                before = self.source.known_version()
                v = self.source.upsert(with_stamp(df, "_updated_at", stamp),
                                       operation=f"MERGE {part}", stamp=stamp, skip_empty=True)
                if v != before:
                    versions.append(v)
        dels = batch.get("deletes")
        if dels is not None:
            before = self.source.known_version()
            v = self.source.delete(keys_df=dels, operation="DELETE", stamp=stamp, skip_empty=True)
            if v != before:
                versions.append(v)
        return versions

    def delete_where(self, condition: str, stamp: dt.datetime | None = None) -> int:
        return self.source.delete(condition=condition, stamp=stamp)

    def register_views(self, feed_from: int = 1) -> list[str]:
        """Source, Gold, control and the feed (``<source>_changes``) as temp views."""
        names = [self.source.create_view(R.SILVER_ORDERS.view_name),
                 self.gold.create_view(R.GOLD_ORDERS.view_name),
                 self.control.create_view(R.CONTROL.view_name)]
        if (self.source.current_version() or 0) >= feed_from:
            names.append(self.source.create_changes_view(
                f"{R.SILVER_ORDERS.view_name}_changes", feed_from))
        return names

    def propagate(self, group_cols=(R.ORDER_GROUP,), stamp: dt.datetime | None = None):
        return inc.propagate(self.source, self.gold, self.control, self.dataset,
                             list(group_cols), R.ORDER_UNITS, R.ORDER_AMOUNT, stamp)


def seeded_case(spark: SparkSession, root: str, orders: DataFrame) -> tuple[OrdersCase, DataFrame]:
    """Seed the orders role table; returns the case and the role rows."""
    case = OrdersCase(spark, root)
    rows = R.orders_rows(orders)
    case.seed(rows, stamp_at(0))
    return case, rows


def run_standard(spark: SparkSession, root: str, orders: DataFrame, propagate: bool = True):
    """Seed (v0), cold start, apply the validated batch (v1..v3), propagate."""
    case, rows = seeded_case(spark, root, orders)
    if propagate:
        case.propagate(stamp=stamp_at(1))
    case.apply_batch(R.valid_batch(case.source.read(0).drop("_updated_at")), stamp_at(2), single_commit=False)
    if propagate:
        case.propagate(stamp=stamp_at(3))
    return case
