"""T4: hourly tumbling metrics per event type.

Each micro-batch is appended to an hourly event log, and the hours that it touches are
recomputed from the log and replaced in Gold. An event that arrives late, by any time, is
counted in its hour: nothing falls behind a watermark, and no state is kept between
runs (``run_hourly``). ``run_windows`` is the stateful stream with a watermark, for
consumers that want final windows only.

Timestamps of the test data are ``timestamp_ntz``; a watermark needs a ``timestamp``, so
event time is cast (session time zone UTC).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.money import cents, from_cents, mean_cents
from refinery.operators.joins import measured
from refinery.sources.files import CORRUPT
from refinery.sources.tables import RAW, REASON, VersionedTable
from refinery.streaming.ingest import drain, split_rows, stream_source

HOURLY_KEYS = ["window_start", "event_type"]


def hourly_aggregate(events: DataFrame, ts: str = "ts", kind: str = "event_type",
                     value: str = "value", window: str = "1 hour",
                     watermark: str = "10 minutes") -> DataFrame:
    """The windowed aggregate; works on a stream or, without watermark, a batch frame."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, watermark)
    return (e.groupBy(F.window(ts, window).alias("w"), F.col(kind).alias("event_type"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(cents(value)).alias("value_cents"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "n", "value_cents"))


def finish(agg: DataFrame) -> DataFrame:
    """Sum and half-up mean of the value, from the exact cents total."""
    return agg.select("window_start", "window_end", "event_type", "n",
                      from_cents("value_cents").alias("value_sum"),
                      mean_cents("value_cents", "n").alias("value_avg"))


def _hour(ts: str = "ts"):
    return F.date_trunc("hour", F.col(ts).cast("timestamp"))


def _fault():
    """Why an event counts in no hour, or NULL."""
    return (F.when(F.col(CORRUPT).isNotNull(), "corrupt line").when(F.col("ts").isNull(), "no time")
            .when(F.col("event_type").isNull(), "no type"))


def run_hourly(spark: SparkSession, landing: str, schema: T.StructType | str,
               gold: VersionedTable, checkpoint: str, stamp: dt.datetime | None = None,
               max_files_per_trigger: int | None = None) -> dict:
    """Drain pending landing files into ``gold``; returns rows read, late, rejected.

    A row is late if its hour was in Gold before its micro-batch. Malformed lines and
    events without a time or a type are rejected: they stay in the event log with their reason
    (:func:`rejected_events`) and count in no hour. A micro-batch is written once, to its own
    folder of the log, so a replayed one replaces its own; hours are recomputed from the log.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    counts = {"rows": 0, "late": 0, "rejected": 0}

    def replace_hours(batch: DataFrame, batch_id: int) -> None:
        obs = Observation()
        out = (split_rows(batch, _fault(), schema.fieldNames())
               .withColumn("_hour", F.when(F.col(REASON).isNull(), _hour())).withColumn("_day", F.to_date("_hour"))
               .observe(obs, F.count(F.lit(1)).alias("n"), F.count(REASON).alias("bad")))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_day")
         .parquet(f"{_log(gold)}/_batch={batch_id}"))
        counts["rows"] += int(obs.get["n"])
        counts["rejected"] += int(obs.get["bad"])
        log = _read_log(spark, gold, schema).where(F.col(REASON).isNull())
        per_hour, n_hours = measured(log.where(F.col("_batch") == batch_id).groupBy("_hour", "_day")
                                     .agg(F.count(F.lit(1)).alias("n")))
        try:
            if not n_hours:
                return
            days = [r[0] for r in per_hour.select("_day").distinct().collect()]     # days of one batch
            known = gold.exists()
            if known:
                counts["late"] += per_hour.join(gold.read().select(F.col("window_start").alias("_hour")).distinct(),
                                                "_hour", "left_semi").agg(F.sum("n")).first()[0] or 0
            whole = (log.where(F.col("_day").isin(days))        # prunes day folders
                     .join(per_hour.select("_hour"), "_hour", "left_semi"))
            rows = finish(hourly_aggregate(whole))
            if known:       # one row per key by construction
                gold.upsert(rows, HOURLY_KEYS, f"STREAM BATCH {batch_id}", stamp, check_keys=False)
            else:
                gold.overwrite(rows, f"STREAM BATCH {batch_id}", stamp)
        finally:
            per_hour.unpersist()

    drain(stream_source(spark, landing, schema, max_files_per_trigger), replace_hours, checkpoint)
    return counts


def _log(gold: VersionedTable) -> str:
    return f"{gold.path}_events"


def _read_log(spark: SparkSession, gold: VersionedTable, schema: T.StructType) -> DataFrame:
    """The event log with its declared types: a first batch of nothing but bad lines has no
    file to infer them from."""
    extra = T._parse_datatype_string(
        f"_source_file string, {REASON} string, {RAW} string, _hour timestamp, _batch long, _day date")
    return spark.read.schema(T.StructType(schema.fields + extra.fields)).parquet(_log(gold))


def rejected_events(spark: SparkSession, gold: VersionedTable, schema: T.StructType | str) -> DataFrame:
    """Events that count in no hour: reason, raw text, source file."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return (_read_log(spark, gold, schema).where(F.col(REASON).isNotNull())
            .select(F.col(REASON).alias("reason"), F.col(RAW).alias("raw"), F.col("_source_file").alias("source_file")))


WINDOWS_DDL = "window_start timestamp, window_end timestamp, event_type string, n long, value_cents long, _batch long"


def run_windows(spark: SparkSession, landing: str, schema: T.StructType | str, path: str, checkpoint: str,
                watermark: str = "10 minutes", max_files_per_trigger: int | None = None) -> dt.datetime:
    """T4 as a stateful stream: final hourly windows only, appended to ``path``.

    Open windows live in the state store and survive a restart in the checkpoint; a window is
    written once, when the watermark passes its end, and its state is dropped. An event whose
    window is closed is left out (:func:`windows_with_late` counts those). Returns the
    watermark that the run reached: windows that end by then are closed.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    events = stream_source(spark, landing, schema, max_files_per_trigger).where(_fault().isNull())
    q = drain(hourly_aggregate(events, watermark=watermark), write_batch, checkpoint)
    reached = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in p["eventTime"]]
    return max(dt.datetime.fromisoformat(w.replace("Z", "+00:00")).replace(tzinfo=None) for w in reached)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The closed windows that :func:`run_windows` wrote."""
    return finish(spark.read.schema(WINDOWS_DDL).parquet(path))


def windows_with_late(windows: DataFrame, events: DataFrame, closed: dt.datetime) -> DataFrame:
    """Closed windows with the number of events that came too late for them (``late``).

    ``events`` holds all events that landed; windows that only late events would have opened
    have ``n`` 0. Rows that count in no hour are left out."""
    every = (hourly_aggregate(events.where(F.col("ts").isNotNull() & F.col("event_type").isNotNull()))
             .where(F.col("window_end") <= F.lit(closed)).select("window_start", "event_type", F.col("n").alias("_all")))
    n = F.coalesce("n", F.lit(0))
    return (every.join(windows, ["window_start", "event_type"], "left")
            .select("window_start", "event_type", n.cast("long").alias("n"), "value_sum", "value_avg",
                    (F.col("_all") - n).cast("long").alias("late")))
