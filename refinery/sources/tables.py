"""Versioned tables over plain parquet.

Layout of one table at ``path``::

    snapshot/_v=N/                 full rows of version N
    changes/_commit_version=N/     row-level change feed of version N (if on)
    commits/_v=N/                  one row: version, time, operation, counts

A version exists once its commit row exists; the commit row is written last
(``errorifexists``), so a job lost half way leaves no visible version and can
simply be re-run: the uncommitted folders of that version are replaced.
Committed folders are never written again, so nothing is overwritten while
it may be read. One writer per table. Version 0 is the first load and has no feed; reading the feed from
version 0 is refused (F5).

Bronze tables are the exception: :class:`PartitionedTable` keeps one folder
with a date partition, replaced per day by dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence
import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.contracts import Contract, conform, row_fault
from refinery.functions.stamps import now_or
from refinery.operators import merge as M
from refinery.operators.joins import measured
from refinery.session import settings

COMMIT_DDL = ("version long, committed_at timestamp, operation string, "
              "num_rows long, num_changes long")
COMMIT_TS = "_commit_timestamp"
COMMIT_VERSION = "_commit_version"
FEED_FIELDS = [T.StructField(M.CHANGE_TYPE, T.StringType()), T.StructField(COMMIT_TS, T.TimestampType()),
               T.StructField(COMMIT_VERSION, T.IntegerType())]


class TableError(RuntimeError):
    pass


class VersionedTable:
    """A table with versions and an optional change feed, stored as parquet."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (),
                 change_feed: bool = False, contract: Contract | None = None,
                 partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.keys = list(keys or (contract.keys if contract else ()))
        # snapshot folders partitioned by these (low-cardinality) columns, so
        # reads filtered on them prune folders at the scan
        self.partition_by = list(partition_by or (contract.partitions if contract else ()))
        self.change_feed = change_feed or bool(contract and contract.change_data_feed)
        # newest version this object knows of (one writer per table)
        self._version: int | None = None
        self._version_read = False

    # ---- reads ---------------------------------------------------------
    def history(self) -> DataFrame:
        """Commit rows, one per version (DESCRIBE HISTORY)."""
        try:
            return (self.spark.read.schema(COMMIT_DDL + ", _v long")
                    .parquet(f"{self.path}/commits").drop("_v"))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":      # only a missing folder is "no table"
                raise
            return self.spark.createDataFrame([], COMMIT_DDL)

    def current_version(self) -> int | None:
        """Newest committed version, or None, from the names of the commit files (one
        small file per version): no job runs."""
        found = (re.search(r"/_v=(\d+)/", f) for f in self.history().inputFiles())
        self._version = max((int(m.group(1)) for m in found if m), default=None)
        self._version_read = True
        return self._version

    def commit_row(self, version: int):
        """The commit row of one version (only its file is read)."""
        return self.spark.read.schema(COMMIT_DDL).parquet(f"{self.path}/commits/_v={version}").first()

    def num_rows(self, version: int | None = None) -> int:
        """A12 from the commit row: rows of one version, without reading its data."""
        v = self.known_version() if version is None else version
        return 0 if v is None else int(self.commit_row(v)["num_rows"])

    def change_rows(self, starting_version: int, ending_version: int) -> int:
        """A6 from the commit rows: change rows recorded for versions start..end."""
        if starting_version > ending_version:
            return 0
        files = [f"{self.path}/commits/_v={v}" for v in range(starting_version, ending_version + 1)]
        rows = self.spark.read.schema(COMMIT_DDL).parquet(*files).select("num_changes").collect()
        return sum(r[0] for r in rows)

    def known_version(self) -> int | None:
        """The newest version this object has seen or written (reads it once if unknown)."""
        return self._version if self._version_read else self.current_version()

    def exists(self) -> bool:
        """S7."""
        return self.known_version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of one version (the newest this object knows by default;
        call ``current_version()`` first to pick up another writer's commit)."""
        v = self.known_version() if version is None else version
        if v is None:
            raise TableError(f"{self.path}: table does not exist")
        if self.contract is not None:
            # the contract's types (partition values are not re-inferred) and order
            return (self.spark.read.schema(self.contract.schema).parquet(self._snapshot(v))
                    .select(*self.contract.names))
        return self.spark.read.parquet(self._snapshot(v))

    def read_changes(self, starting_version: int, ending_version: int | None = None) -> DataFrame:
        """Change rows of versions start..end, both inclusive.

        Only the folders of the range are listed. A version that is not committed, or
        whose change rows are gone, is an error, never a shorter result.
        """
        if not self.change_feed:
            raise TableError(f"{self.path}: change feed is not enabled")
        if starting_version < 1:
            raise TableError("the change feed starts at version 1 (version 0 is the creation)")
        current = self.known_version()
        if current is None or ending_version is None or ending_version > current:
            current = self.current_version()        # another writer may have committed
        if current is None:
            raise TableError(f"{self.path}: table does not exist")
        if ending_version is None:
            # open range: up to the newest committed version, never the folder of a
            # version whose job died before its commit row
            ending_version = current
        if ending_version > current:
            raise TableError(f"{self.path}: version {ending_version} is not committed")
        if starting_version > ending_version:
            raise TableError(f"{self.path}: no versions from {starting_version} to {ending_version}")
        folders = [f"{self.path}/changes/{COMMIT_VERSION}={v}"
                   for v in range(starting_version, ending_version + 1)]
        reader = self.spark.read.option("basePath", f"{self.path}/changes")
        if self.contract is not None:       # declared types: no file is opened to infer them
            reader = reader.schema(T.StructType(self.contract.schema.fields + FEED_FIELDS))
        try:
            return reader.parquet(*folders)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            raise TableError(f"{self.path}: change rows of versions {starting_version} to "
                             f"{ending_version} are not all there") from exc

    def feed_complete(self, starting_version: int, ending_version: int) -> bool:
        """every version of the range still has its change rows (an empty change
        set still has its file)."""
        if starting_version > ending_version:
            return starting_version >= 1
        try:
            self.read_changes(starting_version, ending_version)
        except TableError:
            return False
        return True

    # ---- SQL ------------------------------------------------------------
    def create_view(self, name: str, version: int | None = None) -> str:
        """Expose a version (newest by default) to ``spark.sql`` as a temp view."""
        self.read(version).createOrReplaceTempView(name)
        return name

    def create_changes_view(self, name: str, starting_version: int,
                            ending_version: int | None = None) -> str:
        """The feed from ``starting_version`` on as a temp view, the counterpart of
        ``table_changes(t, v)``: ``SELECT _change_type, COUNT(*) FROM name GROUP BY 1``."""
        self.read_changes(starting_version, ending_version).createOrReplaceTempView(name)
        return name

    def create_changes_function(self, name: str, upto: int | None = None) -> str:
        """The feed as a SQL table function, ``SELECT ... FROM name(v)``: the change rows of
        version ``v`` on, up to the newest (or ``upto``). The version is a partition column, so
        only the folders from ``v`` on are read. Versions before 1 and after the newest are refused
        when the call runs."""
        feed = self.read_changes(1, upto)
        last = self.known_version() if upto is None else upto
        view = self.create_changes_view(f"{name}_feed", 1, upto)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema.fields)
        names = ", ".join(f"`{c}`" for c in feed.columns)
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(starting BIGINT) RETURNS TABLE({cols}) RETURN "
            f"SELECT {names} FROM {view} WHERE {COMMIT_VERSION} >= CASE WHEN starting BETWEEN 1 AND {last} "
            f"THEN starting ELSE raise_error('no change rows from version ' || coalesce(string(starting), 'null')) END")
        return name

    # ---- writes --------------------------------------------------------
    def overwrite(self, df: DataFrame, operation: str = "WRITE",
                  stamp: dt.datetime | None = None) -> int:
        """K3: replace the whole table; with a feed, changes come from F1."""
        df = self._conform(df)
        v = self._next_version()
        changes = None
        if self.change_feed and v > 0:
            def changes(new):
                written = new()
                if self.keys:   # a keyed diff needs unique keys, or it would pair rows
                    M.require_unique_keys(written, self.keys, "new table")
                return M.diff_changes(self.read(v - 1), written, self.keys)
        return self._commit(v, df, changes, operation, stamp)

    def upsert(self, source: DataFrame, keys: Sequence[str] | None = None,
               operation: str = "MERGE", stamp: dt.datetime | None = None,
               check_keys: bool = True, skip_empty: bool = False) -> int:
        """K4: matched rows updated, the rest inserted; duplicate/NULL keys refused.

        The batch is cached once, so its size is known to the joins (see ``joins.py``).
        """
        keys = list(keys or self.keys)
        v = self._next_version()
        if v == 0:
            if check_keys:
                M.require_unique_keys(source, keys)
            return self.overwrite(source, operation, stamp)
        source = self._conform(source).persist()
        matched = None
        try:
            n = M.require_unique_keys(source, keys) if check_keys else source.count()
            if n == 0 and skip_empty:
                return v - 1            # nothing to merge: no new version
            old = self.read(v - 1)
            new = M.upsert_frame(old, source, keys)
            if self.change_feed:    # batch-sized; computed once for both feed branches
                matched = M.matched_rows(old, source, keys).persist()
            changes = ((lambda _new: M.upsert_changes(old, source, keys, matched))
                       if self.change_feed else None)
            return self._commit(v, new, changes, operation, stamp)
        finally:
            source.unpersist()
            if matched is not None:
                matched.unpersist()

    def merge_latest(self, latest: DataFrame, keys: Sequence[str] | None = None,
                     operation: str = "FULL MERGE", stamp: dt.datetime | None = None,
                     newer: Sequence[str] = ()) -> int:
        """K6: merge a source that holds one row per key by construction (``latest_per_key``).

        For sources as large as the table: one full outer join, for which each side is
        shuffled once by the key; the source's shuffle is the one its latest-per-key window
        already made. Nothing is cached and the keys are not counted again. With ``newer``
        a stored row stays if it is the newer one in these columns, and a source of which no
        row is taken makes no new version.
        """
        keys = list(keys or self.keys)
        v = self._next_version()
        if v == 0:
            return self.overwrite(latest, operation, stamp)
        old = self.read(v - 1)
        wins = Observation() if newer else None
        if self.contract:   # a null test on a key hides that the source is dealt by it, so
            latest = conform(latest, self.contract, check_nulls=False)      # it follows the join
        new = self._conform(M.full_outer_merge(old, latest, keys, newer, wins))
        changes = ((lambda written: M.diff_changes(self.read(v - 1), written(), keys))
                   if self.change_feed else None)
        return self._commit(v, new, changes, operation, stamp, wins)

    def delete(self, keys_df: DataFrame | None = None, condition=None,
               keys: Sequence[str] | None = None, operation: str = "DELETE",
               stamp: dt.datetime | None = None, skip_empty: bool = False) -> int:
        """K5: delete by a key frame (anti join) or by a predicate."""
        keys = list(keys or self.keys)
        v = self._next_version()
        if v == 0:
            raise TableError(f"{self.path}: table does not exist")
        old = self.read(v - 1)
        if keys_df is not None:
            keys_df, n = measured(keys_df.select(*keys))
            if n == 0 and skip_empty:
                keys_df.unpersist()
                return v - 1            # nothing to delete: no new version
        try:
            new = M.delete_frame(old, keys, keys_df, condition)
            changes = ((lambda _new: M.delete_changes(old, keys, keys_df, condition))
                       if self.change_feed else None)
            return self._commit(v, new, changes, operation, stamp)
        finally:
            if keys_df is not None:
                keys_df.unpersist()

    def apply(self, upserts: DataFrame | None = None, delete_keys: DataFrame | None = None,
              keys: Sequence[str] | None = None, operation: str = "APPLY BATCH",
              stamp: dt.datetime | None = None) -> int:
        """K4 + K5 in one commit: one rewrite of the table for a whole batch.

        A key both upserted and deleted ends deleted (deletes apply last).
        Returns the current version unchanged when the batch is empty.
        """
        keys = list(keys or self.keys)
        v = self._next_version()
        if v == 0:
            raise TableError(f"{self.path}: table does not exist")
        spark = self.spark
        ups = (self._conform(upserts) if upserts is not None
               else spark.createDataFrame([], self.read(v - 1).schema)).persist()
        dels = (delete_keys.select(*keys) if delete_keys is not None
                else ups.select(*keys).limit(0)).persist()
        matched = None
        try:
            if M.require_unique_keys(ups, keys) + dels.count() == 0:
                return v - 1
            kept_ups = ups.join(dels, keys, "left_anti")
            old = self.read(v - 1)
            touched = ups.select(*keys).unionByName(dels)
            # the touched keys leave the table once; the kept upserts are among them
            new = M.delete_frame(old, keys, touched).unionByName(M.align(kept_ups, old.columns))
            if self.change_feed:    # batch-sized; computed once for both feed branches
                matched = M.matched_rows(old, kept_ups, keys).persist()
            changes = ((lambda _new: M.upsert_changes(old, kept_ups, keys, matched)
                        .unionByName(M.delete_changes(old, keys, dels)))
                       if self.change_feed else None)
            return self._commit(v, new, changes, operation, stamp)
        finally:
            ups.unpersist()
            dels.unpersist()
            if matched is not None:
                matched.unpersist()

    def replace_groups(self, groups: DataFrame, rows: DataFrame, keys: Sequence[str] | None = None,
                       operation: str = "REPLACE GROUPS", stamp: dt.datetime | None = None) -> int:
        """Upsert ``rows`` and delete the ``groups`` keys that ``rows`` lacks, in one commit."""
        keys = list(keys or self.keys)
        v = self._next_version()
        rows = self._conform(rows)
        if v == 0:
            return self._commit(v, rows, None, operation, stamp)
        old = self.read(v - 1)
        g = groups.select(*keys)
        new = old.join(g, keys, "left_anti").unionByName(rows.select(old.columns))
        changes = ((lambda new_: M.diff_changes(old.join(g, keys, "left_semi"),
                                                new_().join(g, keys, "left_semi"), keys))
                   if self.change_feed else None)
        return self._commit(v, new, changes, operation, stamp)

    def replace_where(self, condition: Column, rows: DataFrame, operation: str = "REPLACE",
                      stamp: dt.datetime | None = None) -> int:
        """Rows that meet ``condition`` are replaced by ``rows``, without a join."""
        v = self._next_version()
        rows = self._conform(rows)
        if v == 0:
            return self._commit(v, rows, None, operation, stamp)
        old = self.read(v - 1)
        new = M.delete_frame(old, condition=condition).unionByName(rows.select(old.columns))
        changes = ((lambda written: M.diff_changes(old, written(), self.keys)) if self.change_feed else None)
        return self._commit(v, new, changes, operation, stamp)

    # ---- internals -----------------------------------------------------
    def _snapshot(self, v: int) -> str:
        return f"{self.path}/snapshot/_v={v}"

    def _next_version(self) -> int:
        cur = self.known_version()
        return 0 if cur is None else cur + 1

    def _conform(self, df: DataFrame) -> DataFrame:
        return conform(df, self.contract) if self.contract else df

    def _commit(self, v: int, new: DataFrame, changes, operation: str,
                stamp: dt.datetime | None, wins: Observation | None = None) -> int:
        """``wins``: counts, while the rows are written, those that are news; none: no version."""
        ts = stamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        num_rows = _write_counted(new, self._snapshot(v), self.partition_by)
        if wins is not None and not wins.get["n"]:
            return v - 1        # the folder has no commit row: the next version replaces it
        num_changes = 0
        if changes is not None:
            written = lambda: self.read(v)
            feed = changes(written).withColumn(COMMIT_TS, now_or(ts))
            num_changes = _write_counted(feed, f"{self.path}/changes/{COMMIT_VERSION}={v}")
        (self.spark.createDataFrame([(v, ts, operation, num_rows, num_changes)], COMMIT_DDL)
         .coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/_v={v}"))
        self._version, self._version_read = v, True
        self.last_rows = num_rows       # for the operations log
        return v


def _write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write parquet and count the rows on the way (no second scan).

    Overwrite is safe here: the folder belongs to a version that has no commit
    row yet, so nobody reads it; a re-run after a lost job replaces the
    half-written folder.
    """
    obs = Observation()
    if partition_by:    # even files per partition folder, hot partitions split
        df = df.hint("rebalance", *partition_by)
    # static: the whole folder is replaced, whatever the session's overwrite mode;
    # a partition left by a dead attempt must not survive into the version
    w = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


class PartitionedTable:
    """K1/K2: a Bronze table replaced one partition at a time, or appended."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = (),
                 contract: Contract | None = None, append: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.partition_by = list(partition_by or (contract.partitions if contract else ()))
        self.append = append    # a log (e.g. change records): partitioned, never replaced

    def write(self, df: DataFrame) -> None:
        """Overwrite the partitions present in ``df``; append when unpartitioned
        (or when the table is an append-only log)."""
        if self.contract:
            df = conform(df, self.contract)
        if self.append:
            w = df.write.mode("append")
            (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(self.path)
        elif self.partition_by:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*self.partition_by).parquet(self.path))
        else:
            df.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


KEPT, REJECTED = "kept", "rejected"
STATUS, REASON, RAW, BATCH, DAY = "_status", "_reason", "_raw", "_batch", "_ingested_date"
#: An ingest keeps a file open per outcome, so no task sorts its rows by outcome; tasks read
#: a bounded piece of the landing, and row groups are small enough to be dealt to many tasks.
INGEST_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.files.maxPartitionBytes": "32m"}
ROW_GROUP_BYTES = 32 << 20
REJECTED_COLUMNS = ["reason", "raw", "source_file", DAY]


class IngestTable:
    """A Bronze table that takes every row of an ingest: fitting ones and rejected ones.

    One job reads the landing once and writes both outcomes; the outcome is a partition
    column (``_status``), below the ingestion day::

        _ingested_date=D/_status=kept|rejected/              one full load a day
        _batch=B/_ingested_date=D/_status=kept|rejected/     a log, one folder per landed batch

    The folder of the day (or batch) is replaced as a whole, rejected rows included, so a
    re-run neither doubles nor keeps stale ones. A table without partitions appends.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None,
                 contract: Contract | None = None, partitioned: bool = True):
        self.spark, self.path, self.contract = spark, path.rstrip("/"), contract
        self.schema = contract.schema if contract else schema
        self.partitioned = partitioned

    def ingest(self, rows: DataFrame, day: dt.date, corrupt: str | None = None, fault: Column | None = None,
               batch: str | None = None) -> dict[str, int]:
        """Write one run's rows; returns how many were kept and rejected.

        ``rows`` carries the table's columns but the day. Rows are rejected that could not be
        parsed (``corrupt``, the column with their text), that have the caller's ``fault``, or that
        do not fit the contract (null in a NOT NULL column, a value that is no such type).
        """
        data = [f for f in self.schema.fields if f.name != DAY]
        why = [F.when(F.col(corrupt).isNotNull(), "corrupt line")] if corrupt else []
        why += [fault] if fault is not None else []
        if self.contract is not None:
            why.append(row_fault(rows.withColumn(DAY, F.lit(day)), self.contract))
        reason = F.coalesce(*why, F.lit(None).cast("string"))
        text = F.to_json(F.struct(*[f.name for f in data if f.name not in ("_ingested_at", "_source_file")]))
        raw = F.coalesce(F.col(corrupt), text) if corrupt else text
        tested = rows.withColumn(REASON, reason)
        out = tested.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in data], REASON,
            F.when(F.col(REASON).isNotNull(), raw).alias(RAW),
            F.when(F.col(REASON).isNull(), KEPT).otherwise(REJECTED).alias(STATUS))
        obs = Observation()
        out = out.observe(obs, F.count(F.lit(1)).alias("n"), F.count(REASON).alias("bad"))

        def writer(df: DataFrame, mode: str):
            return df.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES)
        with settings(self.spark, INGEST_SETTINGS):
            if not self.partitioned:
                writer(out.withColumn(DAY, F.lit(day)), "append").partitionBy(STATUS).parquet(self.path)
            elif batch is None:
                (writer(out, "overwrite").option("partitionOverwriteMode", "static")
                 .partitionBy(STATUS).parquet(f"{self.path}/{DAY}={day.isoformat()}"))
            else:
                (writer(out.withColumn(DAY, F.lit(day)), "overwrite").option("partitionOverwriteMode", "static")
                 .partitionBy(DAY, STATUS).parquet(f"{self.path}/{BATCH}={batch}"))
        found = obs.get
        return {KEPT: int(found["n"] - found["bad"]), REJECTED: int(found["bad"])}

    def _all(self) -> DataFrame:
        extra = [T.StructField(n, T.StringType()) for n in (REASON, RAW, STATUS, BATCH)]
        fields = [f for f in self.schema.fields if f.name != DAY] + [T.StructField(DAY, T.DateType())]
        # declared types, nullable: rejected rows lack what they were rejected for
        return self.spark.read.schema(T.StructType(
            [T.StructField(f.name, f.dataType) for f in fields] + extra)).parquet(self.path)

    def read(self, batch: str | None = None) -> DataFrame:
        """The rows that were kept, in the declared order; ``batch`` reads one landed batch."""
        rows = self._all().where(F.col(STATUS) == KEPT)
        if batch is not None:
            rows = rows.where(F.col(BATCH) == batch)
        names = [f.name for f in self.schema.fields]
        return rows.select(*names, *([] if DAY in names else [DAY]))

    def rejected(self) -> DataFrame:
        """Rejected rows: reason, raw text, source file, ingestion day."""
        return self._all().where(F.col(STATUS) == REJECTED).select(
            F.col(REASON).alias("reason"), F.col(RAW).alias("raw"), F.col("_source_file").alias("source_file"), DAY)


QUARANTINE_DDL = "step string, reason string, raw string, source_file string"


OPS_DDL = ("run_id string, step string, target string, status string, "
           "rows long, message string, logged_at timestamp")


def log_operation(spark: SparkSession, path: str, run_id: str, step: str, target: str,
                  status: str, rows: int | None, message: str = "",
                  stamp: dt.datetime | None = None) -> None:
    """Append one record per ingest or promotion to the operations log."""
    (spark.createDataFrame([(run_id, step, target, status, rows, message)],
                           "run_id string, step string, target string, status string, "
                           "rows long, message string")
     .withColumn("logged_at", now_or(stamp))
     .coalesce(1).write.mode("append").parquet(path))
