"""The small side of a join, measured.

A batch, a key list or a set of groups is usually small next to the table it
meets, but a filter over a 100 TB table is estimated at 100 TB, so Spark would
shuffle the table. Here the small side is computed once; from then on the
planner knows its size in bytes and broadcasts it under
``spark.sql.autoBroadcastJoinThreshold``. A larger one is joined by a shuffle, with
the runtime splitting skewed partitions. There is one plan for every size, and no bound
of this library's own (but for the sales promotion, which merges a large increment by one
join of both sides, see ``plans.pipeline.LARGE_SHARE``).

Two forms:

* :func:`measured` caches it (gone with its executors, then computed again).
* :func:`written` writes it to the shared scratch folder. Its rows carry a count, and it
  is read through a filter on that count. Spark only derives a runtime filter from a side
  with a selective predicate, so this is what lets it prune partition folders of the table
  (dynamic partition pruning, when the side is broadcast) and drop rows of the table before
  they are shuffled (runtime Bloom filter, when it is too large to broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from refinery.session import work_dir

HITS = "_hits"


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` cached, and its number of rows (a plain count, which fills the cache)."""
    df = df.persist()
    return df, df.count()


def written(df: DataFrame, keys: Sequence[str], name: str = "keys") -> tuple[DataFrame, int]:
    """The distinct ``keys`` of ``df`` from a scratch table, and how many there are."""
    spark, obs = df.sparkSession, Observation()
    path = work_dir(spark, name)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(HITS))
    counted.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
    found = spark.read.schema(counted.schema).parquet(path).where(F.col(HITS) > 0)
    return found.select(*keys), int(obs.get["n"])
