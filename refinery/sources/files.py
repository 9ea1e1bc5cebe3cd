"""Landing files: JSON Lines in (S1, S9) and out (K12), with ingest metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions.stamps import now_or

CORRUPT = "_corrupt_record"
#: Rows of one compressed landing file.
COMPACT_ROWS = 250_000
# Microsecond time formats, so timestamps survive a JSON round trip
# (Spark's JSON default keeps milliseconds only).
TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str,
               keep_corrupt: bool = True, options: dict | None = None) -> DataFrame:
    """A JSON Lines folder, read whole and recursively, with a fixed schema.

    No inference: the schema comes from the contract. Lines that do not parse
    (or values that do not fit their type) land in ``_corrupt_record`` instead
    of failing the job or silently turning a column into strings.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    opts = {"multiLine": "false", "recursiveFileLookup": "true", "mode": "PERMISSIVE",
            **TIME_OPTIONS}
    opts.update(options or {})
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return spark.read.schema(schema).options(**opts).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", compact: bool = False) -> None:
    """One JSON object per line, UTF-8, one file per partition.

    ``compact`` writes gzip files of at most ``COMPACT_ROWS`` rows: a sale takes a seventh of
    the bytes, and as one gzip file is read by one task, their number keeps readers parallel.
    Gzip's fastest level: the default one takes more CPU time than all the rest of a landing.
    """
    w = (df.write.mode(mode).option("encoding", "UTF-8").options(**TIME_OPTIONS)
         .option("ignoreNullFields", "false"))
    if compact:
        w = (w.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
             .option("maxRecordsPerFile", COMPACT_ROWS))
    w.json(path)


def add_ingest_metadata(df: DataFrame, ingested_at: dt.datetime | None = None,
                        ingested_date: dt.date | None = None) -> DataFrame:
    """``_ingested_at``, ``_ingested_date`` and ``_source_file``.

    The file path comes from the scan's hidden ``_metadata`` column, so it is
    only available on a frame read straight from files (a stream selects it
    at its source, see :func:`refinery.streaming.ingest.stream_source`).
    """
    at = now_or(ingested_at)
    day = F.lit(ingested_date).cast("date") if ingested_date else F.to_date(at)
    out = df.withColumn("_ingested_at", at).withColumn("_ingested_date", day)
    if "_source_file" in df.columns:
        return out
    return out.withColumn("_source_file", F.col("_metadata.file_path"))


def read_change_files(spark: SparkSession, path: str, schema: T.StructType | str,
                      op_col: str = "op_type") -> DataFrame:
    """Landing files whose rows carry an operation column (I/U/D)."""
    df = read_jsonl(spark, path, schema)
    if op_col not in df.columns:
        raise ValueError(f"change files need an {op_col} column")
    return df.withColumn(op_col, F.upper(F.trim(F.col(op_col))))
