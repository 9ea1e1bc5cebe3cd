"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "headline_total", "value": <sum of medians>, "unit": "sec",
   "queries": {name: median sec}, "sf": ..., "incremental": {...}}

Each query is run to completion with the ``noop`` sink (full computation,
nothing collected to the driver). One warm-up, then the median of
$BENCH_REPEAT runs (default 3). The ``incremental`` block times the
propagation step alone (a batch touching all groups, and one touching a
single group) against a full recompute of the same Gold table on the same
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "kpi_daily", "silver_full_merge", "silver_incremental_merge", "layer_counts",
    "upsert_orders", "apply_change_batch", "apply_batch_single_commit",
    "change_feed_rows", "incremental_aggregate", "delta_aggregate", "amount_violations",
    "duplicate_keys", "cdc_soft_delete", "stream_ingest", "stream_hourly",
]


def _run(fn, spark, sf) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _incremental(spark, sf, repeat: int) -> dict:
    """Propagate alone vs a full recompute of Gold, on the same source version.

    ``all_groups``: the standard batch (touches every state);
    ``one_group``: a delete inside one state, where the recompute reads only
    that state's partition folder.
    """
    from refinery.operators import incremental as inc
    from refinery.plans import roles as R
    from refinery.plans.changefeed import seeded_case, stamp_at
    from refinery.session import work_dir

    def full(case):
        t0 = time.perf_counter()
        agg = inc.aggregate_groups(case.source.read(), [R.ORDER_GROUP], None,
                                   R.ORDER_UNITS, R.ORDER_AMOUNT, stamp_at(9))
        case.gold.overwrite(agg, "FULL AGGREGATE", stamp_at(9))
        return time.perf_counter() - t0

    out = {"all_groups": [], "one_group": [], "full_recompute": []}
    for i in range(repeat):
        case, rows = seeded_case(spark, work_dir(spark, f"bench_inc{i}"), R.load(spark, sf, "orders"))
        case.propagate(stamp=stamp_at(1))
        case.apply_batch(R.valid_batch(rows), stamp_at(2))
        t0 = time.perf_counter()
        case.propagate(stamp=stamp_at(3))
        out["all_groups"].append(time.perf_counter() - t0)
        case.delete_where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'", stamp_at(4))
        t0 = time.perf_counter()
        case.propagate(stamp=stamp_at(5))
        out["one_group"].append(time.perf_counter() - t0)
        out["full_recompute"].append(full(case))
    return {f"propagate_{k}" if k != "full_recompute" else k: round(statistics.median(v), 3)
            for k, v in out.items()}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]

    from refinery.queries import QUERIES
    from refinery.session import build_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, int(cpus) * 2)))
    spark = build_session(f"local[{cpus}]", shuffle, app="refinery-bench")
    names = only or HEADLINE
    _run(QUERIES["kpi_daily"], spark, sf)            # warm-up
    times = {}
    for name in names:
        runs = [_run(QUERIES[name], spark, sf) for _ in range(repeat)]
        times[name] = round(statistics.median(runs), 3)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if (m := re.search(r"sf([0-9.]+)", sf)) else sf,
        "cpus": int(cpus),
        "repeat": repeat,
    }
    if not only:
        out["incremental"] = _incremental(spark, sf, repeat)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
