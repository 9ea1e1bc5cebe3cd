"""Job entry points (E1-E5): ``python -m refinery.jobs <job> --config cfg.json``.

The config is a JSON document with at least ``{"path": {"root": ...}}`` (the
shared folder holding the layers) and optionally ``"landing"``, plus a
``"spark"`` section of session settings. Each job reuses the session the
runtime provides (``getOrCreate``), runs one step and exits non-zero when the
step reports failed ingestion specs.

Jobs: ingest_bronze, promote_silver, build_gold (batch sales); seed_orders,
apply_batch, propagate (change feed); ingest_changes, promote_customers,
build_customers (CDC); stream_ingest, promote_stream, build_hourly (streams).
``--since`` (a day) makes promote_silver and promote_customers read only what was
ingested since then; promote_stream keeps its position in a control table.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from refinery.plans.cdc import CustomersCase
from refinery.plans.changefeed import OrdersCase
from refinery.plans.ingestion import pipeline_from
from refinery.plans.pipeline import PipelineFailed, SalesPipeline
from refinery.sources.tables import VersionedTable, log_operation
from refinery.streaming.hourly import HOURLY_KEYS, run_hourly
from refinery.streaming.ingest import ingest_available, last_batch, promote


def _session(cfg: dict) -> SparkSession:
    b = SparkSession.builder.appName("refinery-job")
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true",
                 **cfg.get("spark", {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _sales(spark, cfg, contracts: str | None = None) -> SalesPipeline:
    if contracts:
        return pipeline_from(spark, cfg["path"]["root"], contracts, cfg)
    p = SalesPipeline(spark, cfg["path"]["root"])
    if "landing" in cfg["path"]:
        p.landing = f"{cfg['path']['landing'].rstrip('/')}/ventas"
        p.bronze_specs[0].source_path = p.landing
    return p


def _frame(spark, path: str | None):
    if not path:
        return None
    return spark.read.json(path) if path.endswith(".json") else spark.read.parquet(path)


def _stream_job(spark: SparkSession, root: str, args) -> str:
    """Stream jobs, by the name of the landing folder, each logged."""
    name = Path(args.path.rstrip("/")).name
    bronze, log = f"{root}/bronze/stream/{name}", f"{root}/ops_log"
    if args.job == "stream_ingest":
        n = ingest_available(spark, args.path, args.schema, bronze, f"{root}/_checkpoints/{name}",
                             max_files_per_trigger=args.max_files)
        rows, note = n["kept"], f"rejected={n['rejected']} batches={n['batches']}"
    elif args.job == "promote_stream":
        # the last promoted micro-batch is stored next to the stream's checkpoint
        position = VersionedTable(spark, f"{root}/_checkpoints/{name}_promoted", keys=["stream"])
        done = position.read().first()["batch"] if position.exists() else None
        newest = last_batch(spark, bronze)
        rows, note = None, f"batches {done} to {newest}"
        if newest is not None and newest != done:
            keys = args.keys.split(",")
            silver = VersionedTable(spark, f"{root}/silver/stream/{name}", keys=keys)
            promote(spark, bronze, silver, keys, args.order, after_batch=done)
            position.upsert(spark.createDataFrame([(name, newest)], "stream string, batch long"))
    else:
        gold = VersionedTable(spark, f"{root}/gold/stream/{name}_hourly", keys=HOURLY_KEYS)
        counts = run_hourly(spark, args.path, args.schema, gold, f"{root}/_checkpoints/{name}_hourly",
                            max_files_per_trigger=args.max_files)
        rows, note = counts["rows"], f"late={counts['late']} rejected={counts['rejected']}"
    log_operation(spark, log, "", args.job, name, "ok", rows, note)
    return f"rows {rows} {note}"


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="refinery.jobs")
    ap.add_argument("job", choices=["ingest_bronze", "promote_silver", "build_gold", "seed_orders",
                                    "apply_batch", "propagate", "ingest_changes", "promote_customers",
                                    "build_customers", "stream_ingest", "promote_stream", "build_hourly"])
    ap.add_argument("--config", required=True)
    ap.add_argument("--inserts")
    ap.add_argument("--updates")
    ap.add_argument("--deletes")
    ap.add_argument("--rows", help="seed rows (parquet folder or .json)")
    ap.add_argument("--path", help="landing folder of one change batch / stream")
    ap.add_argument("--schema", help="DDL schema of the stream's files")
    ap.add_argument("--max-files", type=int, help="files per micro-batch of a stream")
    ap.add_argument("--contracts", help="folder of ingestion contracts for the batch sales jobs")
    ap.add_argument("--since", type=dt.date.fromisoformat, help="first ingestion day to promote")
    ap.add_argument("--keys", help="comma-separated key columns of a stream's rows")
    ap.add_argument("--order", help="column by which the latest row of a key wins")
    args = ap.parse_args(argv)
    cfg = json.loads(Path(args.config).read_text(encoding="utf-8"))
    spark = _session(cfg)
    root = cfg["path"]["root"].rstrip("/")
    try:
        if args.job == "ingest_bronze":
            _sales(spark, cfg, args.contracts).ingest_bronze()
        elif args.job == "promote_silver":
            _sales(spark, cfg, args.contracts).promote_silver(ingested_since=args.since)
        elif args.job == "build_gold":
            _sales(spark, cfg).build_gold()
        elif args.job == "seed_orders":
            OrdersCase(spark, root).seed(_frame(spark, args.rows))
        elif args.job == "apply_batch":
            batch = {k: _frame(spark, getattr(args, k)) for k in ("inserts", "updates", "deletes")}
            print("versions", OrdersCase(spark, root).apply_batch(batch))
        elif args.job == "propagate":
            print(OrdersCase(spark, root).propagate())
        elif args.job == "ingest_changes":
            case = CustomersCase(spark, root)
            at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            print("version", case.merge_silver(case.ingest_bronze(args.path, at), at))
        elif args.job == "promote_customers":
            print("version", CustomersCase(spark, root).promote_silver(args.since))
        elif args.job == "build_customers":
            print("version", CustomersCase(spark, root).build_gold())
        else:
            print(_stream_job(spark, root, args))
    except PipelineFailed as exc:
        print(f"failed contracts: {exc.failed}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
