"""Session defaults and the shared scratch location.

Scratch tables are written below the folder the cluster names in
``spark.checkpoint.dir``; a local folder is only chosen when none is set and the
master is local (tests and single-machine runs).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "refinery", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside the block, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a local one only if unset."""
    try:
        sc = spark.sparkContext            # not available on a Spark Connect session
    except Exception:  # noqa: BLE001
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="refinery-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(local)
            root = sc.getCheckpointDir()
        else:
            spark.conf.set("spark.checkpoint.dir", local)
            root = local
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one run's tables, below the checkpoint root."""
    return f"{checkpoint_root(spark)}/refinery/{name}-{uuid.uuid4().hex[:12]}"
