"""Bounded file-stream ingest.

``readStream.json`` over the landing folder with a checkpoint, drained by
``trigger(availableNow=True)``: each run reads only the files that arrived
since the last one and then stops. Every micro-batch is written by
``foreachBatch`` to its own ``_batch=<id>`` folder in overwrite mode, so a
micro-batch replayed after a failure replaces its own output instead of
duplicating it (exactly-once into Bronze).
"""

from __future__ import annotations

from collections.abc import Sequence
import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.stamps import now_or
from refinery.operators.joins import measured
from refinery.operators.latest import latest_per_key
from refinery.operators.merge import newer_rows
from refinery.sources.files import CORRUPT, TIME_OPTIONS, add_ingest_metadata, with_corrupt_column
from refinery.sources.tables import RAW, REASON, VersionedTable


def stream_source(spark: SparkSession, landing: str, schema: T.StructType | str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """New JSON Lines files under ``landing`` as a stream; malformed lines keep their
    text in ``_corrupt_record``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = (spark.readStream.schema(with_corrupt_column(schema))
              .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true")
              .option("multiLine", "false").options(**TIME_OPTIONS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing).withColumn("_source_file", F.col("_metadata.file_path"))


def split_rows(batch: DataFrame, reason, schema_names: list[str]) -> DataFrame:
    """Good and rejected rows of a micro-batch in one frame: ``_reason`` (NULL on good rows) and
    the rejected row's text in ``_raw``."""
    text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*schema_names)))
    return (batch.withColumn(REASON, reason).withColumn(RAW, F.when(F.col(REASON).isNotNull(), text))
            .drop(CORRUPT))


def drain(stream: DataFrame, write_batch, checkpoint: str):
    """Run a stream over what is there (``availableNow``) and stop; returns the finished query."""
    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


def ingest_available(spark: SparkSession, landing: str, schema: T.StructType | str,
                     bronze_path: str, checkpoint: str, ingested_at: dt.datetime | None = None,
                     max_files_per_trigger: int | None = None, dedup_keys: Sequence[str] = (),
                     event_time: str | None = None, delay: str = "1 day") -> dict[str, int]:
    """T1 + T2: drain pending landing files into Bronze; returns rows kept, rejected, late
    and the number of micro-batches.

    With ``max_files_per_trigger`` a backlog is drained in several micro-batches, each written
    in one job and never cached. Malformed lines are kept beside the good rows
    (:func:`read_rejected`).

    With ``dedup_keys`` and ``event_time`` a row whose keys came before, in this run or an
    earlier one, is dropped; the state holds a key for ``delay`` of event time, so it does not
    grow with the stream. A row that is more than ``delay`` older than the newest seen is
    dropped too, as its first copy could no longer be told, and counted as late. Rows without
    a key or a time bypass the state.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = schema.fieldNames()
    n = {"kept": 0, "rejected": 0, "batches": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        obs = Observation()
        reason = F.when(F.col(CORRUPT).isNotNull(), "corrupt line")
        out = add_ingest_metadata(split_rows(batch, reason, names), ingested_at)
        out = out.observe(obs, F.count(F.lit(1)).alias("n"), F.count(REASON).alias("bad"))
        out.write.mode("overwrite").parquet(f"{bronze_path}/_batch={batch_id}")
        n["rejected"] += int(obs.get["bad"])
        n["kept"] += int(obs.get["n"] - obs.get["bad"])
        n["batches"] += 1

    stream = stream_source(spark, landing, schema, max_files_per_trigger)
    if dedup_keys:
        keyed = F.col(CORRUPT).isNull() & F.col(event_time).isNotNull()
        for k in dedup_keys:
            keyed = keyed & F.col(k).isNotNull()
        first = (stream.where(keyed).withColumn("_event_time", F.col(event_time).cast("timestamp"))
                 .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(dedup_keys))
                 .drop("_event_time"))
        stream = first.unionByName(stream.where(~keyed))
    q = drain(stream, write_batch, checkpoint)
    n["late"] = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    return n


def read_bronze(spark: SparkSession, bronze_path: str, after_batch: int | None = None) -> DataFrame:
    """Bronze of a stream; ``after_batch`` keeps only later micro-batches (partition pruning)."""
    df = spark.read.parquet(bronze_path).where(F.col(REASON).isNull())
    if after_batch is not None:
        df = df.where(F.col("_batch") > after_batch)
    return df.drop("_batch", REASON, RAW)


def read_rejected(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Malformed lines of a stream's landing files."""
    return (spark.read.parquet(bronze_path).where(F.col(REASON).isNotNull())
            .select(F.lit("stream ingest").alias("step"), F.col(REASON).alias("reason"), F.col(RAW).alias("raw"),
                    F.col("_source_file").alias("source_file")))


def last_batch(spark: SparkSession, bronze_path: str) -> int | None:
    """Highest micro-batch id written to Bronze (a partition-column max)."""
    return spark.read.parquet(bronze_path).agg(F.max("_batch")).first()[0]


def promote(spark: SparkSession, bronze_path: str, silver: VersionedTable, keys: list[str],
            order_col: str, stamp: dt.datetime | None = None,
            after_batch: int | None = None) -> int:
    """Bronze -> Silver after a stream run: latest row per key, merged (K6).

    ``after_batch`` promotes only the micro-batches written after that id, and
    a stored row is replaced only by a row that is not older (``order_col``, then all
    columns). Rows with a null key cannot be merged: they go to ``<bronze_path>_unkeyed``,
    replaced with each promotion of the same range.
    """
    rows = read_bronze(spark, bronze_path, after_batch)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    rows.where(~keyed).write.mode("overwrite").parquet(f"{bronze_path}_unkeyed/_after={after_batch}")
    latest = latest_per_key(rows.where(keyed), keys, [order_col])
    latest = latest.withColumn("_silver_modified_at", now_or(stamp))
    if not silver.exists():
        return silver.overwrite(latest, "STREAM MERGE", stamp)
    if after_batch is None:
        return silver.merge_latest(latest, keys, "STREAM MERGE", stamp)
    latest, _ = measured(latest)
    try:
        fresh = newer_rows(silver.read(), latest, keys, [order_col], skip=("_silver_modified_at",))
        return silver.upsert(fresh, keys, "STREAM MERGE", stamp, check_keys=False, skip_empty=True)
    finally:
        latest.unpersist()
