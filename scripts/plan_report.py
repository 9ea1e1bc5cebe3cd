"""Print a markdown table of the physical plans of the core operators.

Usage: python scripts/plan_report.py [sf_dir]
For each operator: shuffles (Exchange), broadcasts, join strategies, partial
aggregates / window limits, and the scan's pushed filters and read columns.
The plans are the final AQE plans (each frame is run once into ``noop``).
"""
from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from refinery.functions.money import cents, half_up_div  # noqa: E402
from refinery.operators import incremental as inc  # noqa: E402
from refinery.operators import merge as M  # noqa: E402
from refinery.operators import quality as Q  # noqa: E402
from refinery.operators.joins import measured
from refinery.operators.latest import latest_per_key  # noqa: E402
from refinery.plans import roles as R  # noqa: E402
from refinery.plans.changefeed import seeded_case  # noqa: E402
from refinery.plans.gold import compute_kpis  # noqa: E402
from refinery.session import build_session, work_dir  # noqa: E402


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def facts(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return {
        "shuffles": len(re.findall(r"(?<![A-Za-z])Exchange \(", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(", tree)),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin \w+|SortMergeJoin \w+|"
                                                r"ShuffledHashJoin \w+)", tree)))) or "-",
        "partial": "yes" if ("Partial" in plan or tree.count("HashAggregate") >= 2) else "-",
        "pushed": "; ".join(sorted(set(m for m in re.findall(r"PushedFilters: \[(.+?)\]", plan)
                                       if m))) or "-",
        "partition filters": "; ".join(sorted(set(
            m for m in re.findall(r"PartitionFilters: \[(.+?)\]", plan) if m))) or "-",
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    li = R.load(spark, sf, "lineitem")
    rows = R.orders_rows(R.load(spark, sf, "orders"))
    case, _ = seeded_case(spark, work_dir(spark, "plans"), R.load(spark, sf, "orders"))
    table = case.source.read()
    batch = R.valid_batch(rows)
    root = work_dir(spark, "plans_batch")
    batch["updates"].write.parquet(f"{root}/updates")      # a batch arrives as files
    batch["deletes"].write.parquet(f"{root}/deletes")
    upd = spark.read.parquet(f"{root}/updates")
    batch = {"deletes": spark.read.parquet(f"{root}/deletes")}
    R.customer_changes(R.load(spark, sf, "customer")).where("_seq > 2").write.parquet(f"{root}/changes")
    changes = spark.read.parquet(f"{root}/changes")
    customers = (R.load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
                 .withColumn("_seq", F.lit(1).cast("long")).withColumn("is_deleted", F.lit(False)))
    groups, _ = measured(spark.createDataFrame([("F",)], "o_orderstatus string"))
    frames = {
        "A1 daily KPIs": compute_kpis(li, **R.SALES_ROLE),
        "W1 latest per key": latest_per_key(R.sales_landing(li), R.SALES_KEYS, ["l_shipdate"]),
        "K4 upsert (new table)": M.upsert_frame(table.drop("_updated_at"), upd, R.ORDER_KEYS),
        "F1 upsert change rows": M.upsert_changes(table.drop("_updated_at"), upd, R.ORDER_KEYS),
        "K5 delete by keys": M.delete_frame(table, R.ORDER_KEYS, batch["deletes"]),
        "F1 diff of two states": M.diff_changes(rows, M.upsert_frame(rows, upd, R.ORDER_KEYS),
                                                R.ORDER_KEYS),
        "A2 recompute of chosen groups": inc.aggregate_groups(
            table, ["o_orderstatus"], groups, "o_units", "o_totalprice"),
        "K4 + K5 batch in one commit": M.delete_frame(
            table.drop("_updated_at"), R.ORDER_KEYS,
            upd.select(*R.ORDER_KEYS).unionByName(batch["deletes"])).unionByName(upd),
        "K6 not older than stored": M.newer_rows(
            table.drop("_updated_at"), upd, R.ORDER_KEYS, ["o_orderdate"]),
        "K7 CDC merge rows": M.cdc_merge_rows(
            customers, changes.drop("op_time"), R.CUSTOMER_KEYS),
        "A3 affected groups": inc.affected_groups(
            M.upsert_changes(table.drop("_updated_at"), upd, R.ORDER_KEYS), ["o_orderstatus"]),
        "Q2 amount check": Q.amount_violations(
            li, R.SALES_KEYS, "l_quantity",
            half_up_div(cents("l_extendedprice"), F.col("l_quantity").cast("long")),
            "l_extendedprice"),
        "Q1 lifecycle check": Q.transition_violations(upd, table, R.ORDER_KEYS, R.ORDER_GROUP,
                                                      R.ORDER_TRANSITIONS),
        "Q3 batch conflicts": Q.batch_conflicts(upd, upd, batch["deletes"], table, R.ORDER_KEYS),
        "Q4 duplicate keys": Q.duplicate_keys(li, R.SALES_KEYS),
        "P9 filtered KPIs": compute_kpis(li, **R.SALES_ROLE).filter(
            "categoria = 'R' AND canal = 'F'"),
    }
    cols = ["shuffles", "broadcasts", "joins", "partial", "pushed", "partition filters"]
    print("| Operator | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, df in frames.items():
        f = facts(plan_of(df))
        print(f"| {name} | " + " | ".join(str(f[c]).replace("|", "/") for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
