"""Time stamps (P2, P3, X4). A fixed stamp may be passed for reproducible runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def now_or(stamp: dt.datetime | None = None) -> Column:
    """The current instant, or a fixed one, as a literal.

    "Now" is read once on the driver (UTC, with an explicit zone) rather than
    as ``current_timestamp()``, which Spark fixes per query: a persisted frame
    whose blocks are lost with an executor is recomputed by a later query and
    must get the same stamp, or a snapshot and its feed would disagree.
    """
    if stamp is None:
        now = dt.datetime.now(dt.timezone.utc)
        return F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%fZ")).cast("timestamp")
    # as text, read in the session time zone (not the Python process's zone)
    return F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def with_stamp(df: DataFrame, name: str, stamp: dt.datetime | None = None) -> DataFrame:
    return df.withColumn(name, now_or(stamp))
