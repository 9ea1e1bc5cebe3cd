"""The batch sales pipeline: landing JSON -> Bronze -> Silver -> Gold.

Ingestion specs play the role of ingestion contracts: each names a source, a
destination contract with a table of its own, and a strategy, and carries an
``enabled`` switch; :mod:`refinery.plans.ingestion` makes them from JSON documents. Rejected
rows (corrupt landing lines, null keys, unparseable dates) are kept with their reason and
counted in the operations log.
``ingest_bronze`` and ``promote_silver`` run every enabled spec, collect the
names that failed and raise if any did (after trying all of them).
"""

from __future__ import annotations

from dataclasses import dataclass, field
import datetime as dt
from pathlib import Path
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.contracts import Contract
from refinery.operators.joins import measured, written
from refinery.operators.latest import order_columns
from refinery.operators.merge import full_merge_frame, newer_rows
from refinery.plans import roles as R
from refinery.plans.gold import compute_kpis
from refinery.sources.files import CORRUPT, add_ingest_metadata, read_jsonl, write_jsonl
from refinery.functions.dates import as_date
from refinery.functions.stamps import now_or
from refinery.session import settings
from refinery.sources.tables import IngestTable, VersionedTable, log_operation

#: A promotion sorts whole rows, tens of times their size in parquet: a task gets a piece
#: that it sorts in memory, so the bytes spilled do not grow with the input.
PROMOTE_SETTINGS = {"spark.sql.files.maxPartitionBytes": "8m",
                    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
#: An increment of more than this share of the table is merged by one join of both.
LARGE_SHARE = 0.1


@dataclass
class IngestionSpec:
    name: str
    source_path: str
    source_contract: Contract
    destination: Contract
    enabled: bool = True
    options: dict = field(default_factory=dict)
    merge_keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()       # the version that wins, greatest first
    delete_missing: bool = False      # full merge: drop target keys the source lacks


class PipelineFailed(RuntimeError):
    def __init__(self, failed: list[str]):
        super().__init__(f"failed: {failed}")
        self.failed = failed


@dataclass
class SalesPipeline:
    spark: SparkSession
    root: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:8])

    def __post_init__(self):
        self.landing = f"{self.root}/landing/ventas"
        self.bronze = IngestTable(self.spark, f"{self.root}/bronze/batch/ventas_raw",
                                  contract=R.BRONZE_SALES)
        self.silver = VersionedTable(self.spark, f"{self.root}/silver/batch/ventas",
                                     contract=R.SILVER_SALES)
        self.gold = VersionedTable(self.spark, f"{self.root}/gold/batch/ventas_kpis",
                                   contract=R.GOLD_KPIS)
        self.ops_log = f"{self.root}/ops_log"
        self.rejected_sales = VersionedTable(self.spark, f"{self.root}/quarantine/gold")
        # tables of the specs, by their contract's name
        self.tables = {R.BRONZE_SALES.full_name: self.bronze, R.SILVER_SALES.full_name: self.silver}
        self.bronze_specs = [IngestionSpec("ventas", self.landing, R.LANDING_SALES, R.BRONZE_SALES)]
        self.silver_specs = [IngestionSpec("ventas", self.bronze.path, R.BRONZE_SALES,
                                           R.SILVER_SALES, merge_keys=tuple(R.SALES_KEYS),
                                           order=R.SALES_ORDER)]

    def bronze_table(self, contract: Contract) -> IngestTable:
        """The Bronze table of a contract, one folder each."""
        if contract.full_name not in self.tables:
            path = f"{self.root}/bronze/{contract.schema_name}/{contract.name}"
            self.tables[contract.full_name] = IngestTable(self.spark, path, contract=contract)
        return self.tables[contract.full_name]

    def silver_table(self, contract: Contract) -> VersionedTable:
        if contract.full_name not in self.tables:
            path = f"{self.root}/silver/{contract.schema_name}/{contract.name}"
            self.tables[contract.full_name] = VersionedTable(self.spark, path, contract=contract)
        return self.tables[contract.full_name]

    def load_contracts(self, folder: str, config: dict | None = None) -> dict[str, Contract]:
        """Table contracts of a folder (``*.json``), with ``{section.key}`` filled from config."""
        found = [Contract.load(p, config) for p in sorted(Path(folder).glob("*.json"))]
        return {c.full_name: c for c in found}

    def add_bronze_spec(self, name: str, source_path: str, source: Contract, destination: Contract,
                        **options) -> IngestionSpec:
        spec = IngestionSpec(name, source_path, source, destination, **options)
        self.bronze_specs.append(spec)
        return spec

    # A producer drops JSON Lines files in landing
    def land(self, rows: DataFrame, sub: str = "part") -> None:
        write_jsonl(rows, f"{self.landing}/{sub}", compact=True)

    def _log(self, step, target, status, rows, message="", stamp=None):
        log_operation(self.spark, self.ops_log, self.run_id, step, target, status, rows,
                      message, stamp)

    def ingest_bronze(self, ingested_at: dt.datetime | None = None,
                      ingested_date: dt.date | None = None, raise_on_failure: bool = True,
                      table: IngestTable | None = None) -> list[str]:
        """Landing (full load) -> Bronze, replacing the ingestion day's folder.

        The landing is read once and both outcomes are written in one job; rows that could
        not be parsed or do not fit the contract (a null key) are in ``bronze.rejected()``.
        """
        failed = []
        for spec in self.bronze_specs:
            if not spec.enabled:
                continue
            try:
                raw = read_jsonl(self.spark, spec.source_path, spec.source_contract.schema,
                                 options=spec.options)
                at = ingested_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
                rows = add_ingest_metadata(raw, at)
                n = (table or self.bronze_table(spec.destination)).ingest(
                    rows, ingested_date or at.date(), corrupt=CORRUPT)
                self._log("ingest_bronze", spec.destination.full_name, "ok", n["kept"],
                          f"rejected={n['rejected']}", ingested_at)
            except Exception as exc:  # noqa: BLE001 - collected and re-raised below
                failed.append(spec.name)
                self._log("ingest_bronze", spec.destination.full_name, "failed", None,
                          str(exc), ingested_at)
        if failed and raise_on_failure:
            raise PipelineFailed(failed)
        return failed

    def promote_silver(self, stamp: dt.datetime | None = None,
                       raise_on_failure: bool = True,
                       ingested_since: dt.date | None = None) -> list[str]:
        """Bronze -> Silver by full merge: latest row per key, stamped.

        ``ingested_since`` makes the promotion incremental: only the Bronze
        partitions ingested since that day are read (partition pruning), and a
        stored row is replaced only by a row that is not older in the spec's order. A small
        increment is cached and joined as the build side; a large one (``LARGE_SHARE``) is
        merged by one join, for which either side is shuffled once.
        """
        failed = []
        for spec in self.silver_specs:
            if not spec.enabled:
                continue
            try:
                bronze = self.bronze_table(spec.source_contract).read()
                silver = self.silver_table(spec.destination)
                target = silver.read() if silver.exists() else None
                if ingested_since is not None and target is not None:
                    bronze = bronze.where(F.col("_ingested_date") >= F.lit(ingested_since))
                latest = full_merge_frame(None, bronze, spec.merge_keys, spec.order, stamp=stamp)
                with settings(self.spark, PROMOTE_SETTINGS):
                    if ingested_since is not None and target is not None:
                        self._merge_increment(silver, target, latest, bronze.count(), spec, stamp)
                    elif target is None or spec.delete_missing:
                        silver.overwrite(latest, "FULL MERGE", stamp)
                    else:
                        silver.merge_latest(latest, spec.merge_keys, "FULL MERGE", stamp)
                self._log("promote_silver", spec.destination.full_name, "ok", silver.num_rows(), "", stamp)
            except Exception as exc:  # noqa: BLE001
                failed.append(spec.name)
                self._log("promote_silver", spec.destination.full_name, "failed", None,
                          str(exc), stamp)
        if failed and raise_on_failure:
            raise PipelineFailed(failed)
        return failed

    @staticmethod
    def _merge_increment(silver: VersionedTable, target: DataFrame, latest: DataFrame, n: int,
                         spec: IngestionSpec, stamp: dt.datetime | None) -> None:
        """Merge the latest rows of an increment of ``n`` rows; stored rows that are newer stay."""
        skip = ("_silver_modified_at",)
        if n > LARGE_SHARE * silver.num_rows():
            newer = [c for c in order_columns(latest, spec.merge_keys, spec.order) if c not in skip]
            silver.merge_latest(latest, spec.merge_keys, "INCREMENTAL MERGE", stamp, newer)
            return
        latest, _ = measured(latest)
        try:
            fresh = newer_rows(target, latest, spec.merge_keys, spec.order, skip=skip)
            silver.upsert(fresh, spec.merge_keys, "INCREMENTAL MERGE", stamp,
                          check_keys=False, skip_empty=True)
        finally:
            latest.unpersist()

    def build_gold(self, stamp: dt.datetime | None = None, dates: DataFrame | None = None) -> int:
        """Silver -> Gold KPIs (re-running does not duplicate).

        Without ``dates`` the whole table is recomputed; with a frame of touched dates
        (column ``fecha``) only their groups are recomputed and replaced. Sales whose
        date text does not parse have no day: every build replaces ``rejected_sales`` by
        those that Silver holds now (a scan of one column), and the log counts them.
        """
        silver = self.silver.read()
        day = as_date(silver, R.SALES_ROLE["date"])
        why = F.when(F.col(R.SALES_ROLE["date"]).isNull(), "no date").otherwise("unparseable date")
        self.rejected_sales.overwrite(
            silver.where(day.isNull()).select(
                why.alias("reason"), F.to_json(F.struct(*silver.columns)).alias("raw"),
                F.col("_source_file").alias("source_file"), now_or(stamp).alias("quarantined_at")),
            "REJECTED", stamp)
        if dates is not None and self.gold.exists():
            dates, _ = written(dates.where("fecha IS NOT NULL"), ["fecha"], "dates")
            touched = silver.withColumn("fecha", day).join(dates, "fecha", "left_semi").drop("fecha")
            kpis = compute_kpis(touched, stamp=stamp, **R.SALES_ROLE)
            v = self.gold.replace_groups(dates, kpis, keys=["fecha"], operation="RECOMPUTE DATES", stamp=stamp)
            what = "touched dates, "
        else:
            kpis = compute_kpis(silver.where(day.isNotNull()), stamp=stamp, **R.SALES_ROLE)
            v, what = self.gold.overwrite(kpis, "OVERWRITE", stamp), ""
        self._log("build_gold", R.GOLD_KPIS.full_name, "ok", self.gold.num_rows(),
                  f"{what}rejected={self.rejected_sales.num_rows()}", stamp)
        return v

    def register_views(self) -> list[str]:
        """Expose the three layers to ``spark.sql`` under their contract names."""
        self.bronze.read().createOrReplaceTempView(R.BRONZE_SALES.view_name)
        return [R.BRONZE_SALES.view_name,
                self.silver.create_view(R.SILVER_SALES.view_name),
                self.gold.create_view(R.GOLD_KPIS.view_name)]

    def run(self, rows: DataFrame, stamp: dt.datetime | None = None) -> "SalesPipeline":
        self.land(rows)
        self.ingest_bronze(stamp, stamp.date() if stamp else None)
        self.promote_silver(stamp)
        self.build_gold(stamp)
        return self
