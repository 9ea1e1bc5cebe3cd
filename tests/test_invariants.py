"""End-to-end invariants on the sf0.001 tables (SURVEY §5 (3))."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF
from refinery.operators import incremental as inc
from refinery.plans import roles as R
from refinery.plans.changefeed import OrdersCase, run_standard, seeded_case, stamp_at
from refinery.plans.pipeline import SalesPipeline
from refinery.streaming import hourly as H
from refinery.sources.tables import VersionedTable


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _full(case):
    return inc.aggregate_groups(case.source.read(), [R.ORDER_GROUP], None,
                                R.ORDER_UNITS, R.ORDER_AMOUNT).drop("_recalculado_at")


def _gold(case):
    return case.gold.read().select(R.ORDER_GROUP, *inc.AGG_COLUMNS)


def test_incremental_equals_full_after_batches(spark, tmp_root):
    orders = R.load(spark, SF, "orders")
    case, rows = seeded_case(spark, tmp_root, orders)
    assert case.propagate(stamp=stamp_at(1)).mode == "cold"
    case.apply_batch(R.valid_batch(rows), stamp_at(2))
    res = case.propagate(stamp=stamp_at(3))
    assert res.mode == "incremental" and res.change_rows > 0
    assert _rows(_gold(case)) == _rows(_full(case))
    # a batch that empties a group entirely
    case.delete_where("o_orderstatus = 'P'", stamp_at(4))
    res = case.propagate(stamp=stamp_at(5))
    assert res.emptied == 1
    assert _rows(_gold(case)) == _rows(_full(case))
    assert case.propagate(stamp=stamp_at(6)).mode == "noop"


def test_applying_a_batch_twice_equals_once(spark, tmp_root):
    orders = R.load(spark, SF, "orders")
    case, rows = seeded_case(spark, tmp_root, orders)
    batch = R.valid_batch(rows)
    case.apply_batch(batch, stamp_at(2))
    once = _rows(case.source.read())
    v = case.source.current_version()
    case.apply_batch(batch, stamp_at(2))
    assert _rows(case.source.read()) == once
    # the repeated batch changes nothing, so its versions carry no change rows
    assert case.source.read_changes(v + 1).count() == 0


def test_pointer_ahead_of_source_is_refused(spark, tmp_root):
    orders = R.load(spark, SF, "orders")
    case, _ = seeded_case(spark, tmp_root, orders)
    case.propagate(stamp=stamp_at(1))
    other = OrdersCase(spark, tmp_root + "-recreated")
    other.control, other.gold = case.control, case.gold
    other.seed(R.orders_rows(orders))
    inc.advance_pointer(case.control, other.dataset, 5, 0)
    with pytest.raises(ValueError):
        other.propagate()


def test_delta_aggregate_equals_recompute(spark, tmp_root):
    case = run_standard(spark, tmp_root, R.load(spark, SF, "orders"), False)
    prev = inc.aggregate_groups(case.source.read(0), [R.ORDER_GROUP], None,
                                R.ORDER_UNITS, R.ORDER_AMOUNT)
    delta = inc.delta_aggregate(prev, case.source.read_changes(1), [R.ORDER_GROUP],
                                R.ORDER_UNITS, R.ORDER_AMOUNT)
    assert _rows(delta) == _rows(_full(case))


def test_layers_reconcile(spark, tmp_root):
    li = R.load(spark, SF, "lineitem")
    p = SalesPipeline(spark, tmp_root).run(R.sales_landing(li), dt.datetime(2024, 1, 1))
    assert p.bronze.read().count() == li.count()
    assert p.silver.read().count() == li.select(*R.SALES_KEYS).distinct().count()
    assert p.gold.read().count() == p.silver.read().select(
        F.to_date("l_shipdate"), "l_returnflag", "l_linestatus").distinct().count()
    # a second run over the same landing replaces the day and keeps Silver/Gold equal
    p.ingest_bronze(dt.datetime(2024, 1, 1), dt.date(2024, 1, 1))
    p.promote_silver(dt.datetime(2024, 1, 1, 1))
    assert p.bronze.read().count() == li.count()
    assert p.silver.read().count() == li.select(*R.SALES_KEYS).distinct().count()


def test_stream_equals_batch(spark, tmp_root):
    from refinery.sources.files import write_jsonl
    from refinery.queries import EVENT_DDL
    ev = R.load(spark, SF, "events")
    write_jsonl(ev, f"{tmp_root}/landing/a")
    gold = VersionedTable(spark, f"{tmp_root}/gold", keys=H.HOURLY_KEYS)
    H.run_hourly(spark, f"{tmp_root}/landing", EVENT_DDL, gold, f"{tmp_root}/ckpt")
    batch = H.finish(H.hourly_aggregate(ev))
    cols = ["window_start", "event_type", "n", "value_sum", "value_avg"]
    assert _rows(gold.read().select(cols)) == _rows(batch.select(cols))


def test_purged_feed_forces_rebuild(spark, tmp_root):
    """a version whose change rows are gone cannot be propagated; Gold is rebuilt."""
    orders = R.load(spark, SF, "orders")
    case, rows = seeded_case(spark, tmp_root, orders)
    case.propagate(stamp=stamp_at(1))
    # a writer without the feed commits a version: its change rows do not exist
    blind = VersionedTable(spark, case.source.path, keys=R.ORDER_KEYS)
    blind.delete(condition="o_orderstatus = 'F'")
    case.source.current_version()
    res = case.propagate(stamp=stamp_at(2))
    assert res.mode == "rebuild"
    assert _rows(_gold(case)) == _rows(_full(case))


def test_ingest_collects_failures_and_skips_disabled(spark, tmp_root):
    from refinery.plans.pipeline import PipelineFailed
    p = SalesPipeline(spark, tmp_root)
    p.bronze_specs[0].source_path = f"{tmp_root}/no/such/landing"
    with pytest.raises(PipelineFailed) as err:
        p.ingest_bronze(dt.datetime(2024, 1, 1))
    assert err.value.failed == ["ventas"]
    log = spark.read.parquet(p.ops_log).collect()
    assert [(r.step, r.status) for r in log] == [("ingest_bronze", "failed")]
    p.bronze_specs[0].enabled = False
    assert p.ingest_bronze(dt.datetime(2024, 1, 1)) == []


def test_jobs_run_the_change_feed_flow(spark, tmp_root):
    import json
    from refinery import jobs
    rows = R.orders_rows(R.load(spark, SF, "orders"))
    b = R.valid_batch(rows)
    for name, df in [("rows", rows), *b.items()]:
        df.write.parquet(f"{tmp_root}/in/{name}")
    cfg = f"{tmp_root}-cfg.json"
    with open(cfg.replace("file:", ""), "w") as fh:
        json.dump({"path": {"root": f"{tmp_root}/lake"}}, fh)
    cfg = cfg.replace("file:", "")
    assert jobs.main(["seed_orders", "--config", cfg, "--rows", f"{tmp_root}/in/rows"]) == 0
    assert jobs.main(["propagate", "--config", cfg]) == 0
    assert jobs.main(["apply_batch", "--config", cfg, "--inserts", f"{tmp_root}/in/inserts",
                      "--updates", f"{tmp_root}/in/updates",
                      "--deletes", f"{tmp_root}/in/deletes"]) == 0
    assert jobs.main(["propagate", "--config", cfg]) == 0
    case = OrdersCase(spark, f"{tmp_root}/lake")
    assert case.source.current_version() == 1      # one commit for the batch
    assert _rows(_gold(case)) == _rows(_full(case))


def test_single_commit_batch_equals_three_commits(spark, tmp_root):
    orders = R.load(spark, SF, "orders")
    three, rows = seeded_case(spark, f"{tmp_root}/three", orders)
    one, _ = seeded_case(spark, f"{tmp_root}/one", orders)
    batch = R.valid_batch(rows)
    assert three.apply_batch(batch, stamp_at(2), single_commit=False) == [1, 2, 3]
    assert one.apply_batch(batch, stamp_at(2)) == [1]
    assert _rows(one.source.read()) == _rows(three.source.read())
    cols = [c for c in one.source.read_changes(1).columns
            if c not in ("_commit_version", "_commit_timestamp")]
    assert _rows(one.source.read_changes(1).select(cols)) == \
        _rows(three.source.read_changes(1).select(cols))
    one.propagate(stamp=stamp_at(3))
    assert _rows(_gold(one)) == _rows(_full(one))


def test_incremental_promotion_equals_full_promotion(spark, tmp_root):
    """Day 2 lands new sales and late re-emissions; promoting only day 2 gives the
    same Silver as promoting everything."""
    li = R.sales_landing(R.load(spark, SF, "lineitem"))
    day1 = li.where(F.col("l_shipdate") < "1998-01-01")
    day2 = li.where(F.col("l_shipdate") >= "1998-01-01").unionByName(day1.limit(50))
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)

    def run(name, incremental):
        p = SalesPipeline(spark, f"{tmp_root}/{name}")
        p.land(day1, "d1")
        p.ingest_bronze(d1, d1.date())
        p.promote_silver(d1)
        p.land(day2, "d2")
        p.bronze_specs[0].source_path = f"{p.landing}/d2"
        p.ingest_bronze(d2, d2.date())
        p.promote_silver(d2, ingested_since=d2.date() if incremental else None)
        return p.silver.read().select(*[c for c in li.columns])

    assert _rows(run("inc", True)) == _rows(run("full", False))


def test_missing_gold_is_rebuilt_not_patched(spark, tmp_root):
    case, rows = seeded_case(spark, tmp_root, R.load(spark, SF, "orders"))
    case.propagate(stamp=stamp_at(1))
    case.apply_batch(R.valid_batch(rows), stamp_at(2))
    case.gold = VersionedTable(spark, f"{tmp_root}/gold-new", contract=R.GOLD_ORDERS)
    assert case.propagate(stamp=stamp_at(3)).mode == "rebuild"
    assert _rows(_gold(case)) == _rows(_full(case))


def test_dashboard_sql_over_registered_views(spark, tmp_root):
    li = R.load(spark, SF, "lineitem")
    p = SalesPipeline(spark, f"{tmp_root}/sales").run(R.sales_landing(li), dt.datetime(2024, 1, 1))
    assert p.register_views() == ["bronze_batch_ventas_raw", "silver_batch_ventas",
                                  "gold_batch_ventas_kpis"]
    layers = spark.sql("""
        SELECT 'Bronze' AS capa, COUNT(*) AS filas FROM bronze_batch_ventas_raw
        UNION ALL SELECT 'Silver', COUNT(*) FROM silver_batch_ventas
        UNION ALL SELECT 'Gold', COUNT(*) FROM gold_batch_ventas_kpis""")
    got = {r.capa: r.filas for r in layers.collect()}
    assert got["Bronze"] == li.count() and got["Gold"] == p.gold.read().count()
    case = run_standard(spark, f"{tmp_root}/orders", R.load(spark, SF, "orders"), True)
    names = case.register_views()
    assert "silver_cdf_pedidos_changes" in names
    ptr = spark.sql("SELECT MAX(ultima_version) AS v FROM gold_cdf_cdf_control").first().v
    assert ptr == 3
    by_type = spark.sql("""SELECT _change_type, COUNT(*) AS n FROM silver_cdf_pedidos_changes
                           GROUP BY _change_type""").collect()
    assert {r._change_type for r in by_type} == {"insert", "update_preimage", "update_postimage",
                                                 "delete"}


def test_jobs_ingest_changes_and_stream(spark, tmp_root):
    import json
    from refinery import jobs
    from refinery.plans.cdc import CustomersCase
    from refinery.queries import EVENT_DDL
    from refinery.sources.files import write_jsonl
    write_jsonl(R.customer_changes(R.load(spark, SF, "customer")), f"{tmp_root}/in/cdc")
    cfg = (tmp_root + "/cfg.json").replace("file:", "")
    with open(cfg, "w") as fh:
        json.dump({"path": {"root": f"{tmp_root}/lake"}}, fh)
    assert jobs.main(["ingest_changes", "--config", cfg, "--path", f"{tmp_root}/in/cdc"]) == 0
    silver = CustomersCase(spark, f"{tmp_root}/lake").silver
    assert silver.read().count() == R.load(spark, SF, "customer").count()
    write_jsonl(R.load(spark, SF, "events"), f"{tmp_root}/in/events/a")
    args = ["stream_ingest", "--config", cfg, "--path", f"{tmp_root}/in/events",
            "--schema", EVENT_DDL]
    assert jobs.main(args) == 0 and jobs.main(args) == 0      # the second run reads nothing
    bronze = spark.read.parquet(f"{tmp_root}/lake/bronze/stream/events")
    assert bronze.count() == R.load(spark, SF, "events").count()
    flow = ["--config", cfg, "--path", f"{tmp_root}/in/events", "--keys", "event_id", "--order", "ts"]
    assert jobs.main(["promote_stream", *flow]) == 0 and jobs.main(["promote_stream", *flow]) == 0
    assert VersionedTable(spark, f"{tmp_root}/lake/silver/stream/events").read().count() == bronze.count()
    assert jobs.main(["build_hourly", "--config", cfg, "--path", f"{tmp_root}/in/events", "--schema", EVENT_DDL]) == 0
    assert jobs.main(["promote_customers", "--config", cfg]) == 0
    assert jobs.main(["build_customers", "--config", cfg]) == 0
    assert CustomersCase(spark, f"{tmp_root}/lake").gold_table.read().count() > 0
    steps = {r.step for r in spark.read.parquet(f"{tmp_root}/lake/ops_log").select("step").distinct().collect()}
    assert {"ingest_changes", "promote_silver", "build_gold", "stream_ingest", "promote_stream", "build_hourly"} <= steps


def test_correction_with_the_same_date_wins_and_old_copies_lose(spark):
    from refinery.operators.merge import full_merge_frame, newer_rows
    ddl = "k long, d string, amount double, _ingested_at timestamp"
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = spark.createDataFrame([(1, "2024-01-01", 44473.56, d1), (1, "2024-01-01", 44472.56, d2)], ddl)
    order = ("_ingested_at", "d")
    assert full_merge_frame(None, rows, ["k"], order).first()["amount"] == 44472.56
    stored, old = rows.where("amount < 44473"), rows.where("amount > 44473")
    assert newer_rows(stored, old, ["k"], order).count() == 0
    assert newer_rows(old, stored, ["k"], order).count() == 1


def test_malformed_stream_lines_and_null_keys_are_kept_aside(spark, tmp_root):
    from refinery.streaming import ingest as S
    spark.createDataFrame([('{"k": 1, "v": "a"}',), ("{broken",), ('{"v": "no key"}',)],
                          "value string").coalesce(1).write.text(f"{tmp_root}/landing/a")
    bronze, silver = f"{tmp_root}/bronze", VersionedTable(spark, f"{tmp_root}/silver", keys=["k"])
    S.ingest_available(spark, f"{tmp_root}/landing", "k long, v string", bronze, f"{tmp_root}/ckpt")
    for _ in range(2):
        S.promote(spark, bronze, silver, ["k"], "v")
    assert [r.k for r in silver.read().collect()] == [1]
    assert [r.raw for r in S.read_rejected(spark, bronze).collect()] == ["{broken"]
    assert spark.read.parquet(f"{bronze}_unkeyed").count() == 1
