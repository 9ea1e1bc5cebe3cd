"""The CDC use case: change files with I/U/D -> Bronze -> soft-delete Silver -> Gold."""

from __future__ import annotations

from dataclasses import dataclass
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators.merge import cdc_merge_rows, change_fault
from refinery.plans import roles as R
from refinery.plans.reports import customer_gold
from refinery.sources.files import CORRUPT, add_ingest_metadata, read_change_files, write_jsonl
from refinery.sources.tables import IngestTable, VersionedTable, log_operation

CHANGE_DDL = ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
              "c_mktsegment string, op_type string, _seq long, op_time timestamp")
BRONZE_DDL = CHANGE_DDL + ", _ingested_at timestamp, _ingested_date date, _source_file string"


@dataclass
class CustomersCase:
    spark: SparkSession
    root: str

    def __post_init__(self):
        self.landing = f"{self.root}/landing/clientes"
        # a log of change records, one folder per landed batch: a batch that is ingested
        # again replaces its own records, rejected ones included; no other is touched
        self.bronze = IngestTable(self.spark, f"{self.root}/bronze/cdc/clientes_raw",
                                  T._parse_datatype_string(BRONZE_DDL))
        self.silver = VersionedTable(self.spark, f"{self.root}/silver/cdc/clientes",
                                     contract=R.SILVER_CUSTOMERS)
        self.gold_table = VersionedTable(self.spark, f"{self.root}/gold/cdc/clientes_segmento",
                                         contract=R.GOLD_CUSTOMERS)
        self.ops_log = f"{self.root}/ops_log"

    def land(self, changes: DataFrame, name: str) -> str:
        path = f"{self.landing}/{name}"
        write_jsonl(changes, path)
        return path

    def ingest_bronze(self, path: str, ingested_at: dt.datetime) -> DataFrame:
        """One landing batch of change files (S9) to Bronze (P1, K1); returns the batch."""
        rows = add_ingest_metadata(read_change_files(self.spark, path, CHANGE_DDL), ingested_at)
        name = path.rstrip("/").rsplit("/", 1)[-1]
        n = self.bronze.ingest(rows, ingested_at.date(), corrupt=CORRUPT, fault=change_fault(R.CUSTOMER_KEYS),
                               batch=name)
        log_operation(self.spark, self.ops_log, path, "ingest_changes", self.bronze.path, "ok",
                      n["kept"], f"rejected={n['rejected']}", ingested_at)
        return self.bronze.read(batch=name)

    def merge_silver(self, changes: DataFrame, stamp: dt.datetime | None = None) -> int:
        """Apply a change batch with soft deletes.

        The changes are folded to one row per key once; that row set is what the merge caches.
        """
        target = self.silver.read() if self.silver.exists() else None
        if target is None:
            target = self.spark.createDataFrame([], R.SILVER_CUSTOMERS.schema)
        rows = cdc_merge_rows(target, changes, R.CUSTOMER_KEYS, time_col="op_time")
        if not self.silver.exists():
            v = self.silver.overwrite(rows, "CDC MERGE", stamp)
        else:       # one row per key by construction
            v = self.silver.upsert(rows, R.CUSTOMER_KEYS, "CDC MERGE", stamp, check_keys=False)
        log_operation(self.spark, self.ops_log, "", "promote_silver", self.silver.path, "ok", self.silver.num_rows(),
                      "", stamp)
        return v

    def promote_silver(self, since: dt.date | None = None, stamp: dt.datetime | None = None) -> int:
        """C2 as a job: the change log ingested since a day (all of it by default) into Silver.
        Replaying changes is harmless: only newer sequences count."""
        changes = self.bronze.read()
        if since is not None:
            changes = changes.where(F.col("_ingested_date") >= F.lit(since))    # partition pruning
        return self.merge_silver(changes, stamp)

    def gold(self) -> DataFrame:
        """C3."""
        return customer_gold(self.silver.read())

    def build_gold(self, stamp: dt.datetime | None = None) -> int:
        """C3 as a table."""
        v = self.gold_table.overwrite(self.gold(), "OVERWRITE", stamp)
        log_operation(self.spark, self.ops_log, "", "build_gold", self.gold_table.path, "ok",
                      self.gold_table.num_rows(), "", stamp)
        return v

