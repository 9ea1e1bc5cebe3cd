"""Physical plans: the scale properties the operators rely on."""
import re

from pyspark.sql import functions as F

from conftest import SF
from refinery.operators import incremental as inc
from refinery.operators.joins import measured
from refinery.operators.latest import latest_per_key
from refinery.plans import roles as R
from refinery.plans.changefeed import seeded_case


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_latest_per_key_hot_key_is_cut_before_the_shuffle(spark, capsys):
    # key 0 holds a third of all rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("x"))
    out = latest_per_key(df, ["k"], ["x"])
    plan = _plan(out, capsys)
    tree = plan.split("\n\n")[0]
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit", tree), tree
    assert "Partial" in plan and "Final" in plan
    assert out.count() == 20001          # 20,000 other keys + the hot key 0
    assert out.where("k = 0").collect()[0]["x"] == 29997


def test_measured_groups_are_broadcast(spark, capsys):
    rows = R.orders_rows(R.load(spark, SF, "orders"))
    groups, n = measured(rows.where("o_orderstatus = 'F'").select("o_orderstatus").distinct())
    assert n == 1
    agg = inc.aggregate_groups(rows, ["o_orderstatus"], groups, "o_units", "o_totalprice")
    plan = _plan(agg, capsys)
    assert "BroadcastHashJoin LeftSemi" in plan and "SortMergeJoin" not in plan
    groups.unpersist()


def test_counting_the_small_side_has_no_limit(spark, capsys):
    # a limit would send up to the bound of rows of every partition to one task
    from refinery.operators import joins
    import inspect
    assert "limit" not in inspect.getsource(joins.measured)


def test_single_commit_touches_the_table_once(spark, tmp_root, capsys):
    from refinery.operators import merge as M
    case, rows = seeded_case(spark, tmp_root, R.load(spark, SF, "orders"))
    k = F.col("o_orderkey")
    ups, _ = measured(rows.where(k % 10 == 0).withColumn("o_units", F.lit(9)))
    dels, _ = measured(rows.where(k % 17 == 3).select(*R.ORDER_KEYS))
    old = case.source.read().drop("_updated_at")
    touched = ups.select(*R.ORDER_KEYS).unionByName(dels)
    new = M.delete_frame(old, R.ORDER_KEYS, touched).unionByName(M.align(ups, old.columns))
    plan = _plan(new, capsys).split("\n\n")[0]
    assert plan.count("LeftAnti") == 1 and "SortMergeJoin" not in plan


def test_kpi_scan_prunes_columns_and_aggregates_partially(spark, capsys):
    from refinery.queries import kpi_daily, kpi_filtered
    plan = _plan(kpi_daily(spark, SF), capsys)
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string," \
           "l_linestatus:string,l_shipdate:timestamp_ntz>" in plan
    assert plan.count("HashAggregate") >= 2 and "BatchEvalPython" not in plan
    plan = _plan(kpi_filtered(spark, SF), capsys)
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_returnflag,R\).*EqualTo\(l_linestatus,F\)", plan)


def test_above_the_broadcast_threshold_merges_shuffle_and_stay_correct(spark, tmp_root, capsys):
    from refinery.operators import merge as M
    from refinery.sources.tables import VersionedTable
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        src = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
        t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
        t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
        t.upsert(src)
        assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "B"), (3, "c")]
        assert sorted((r.k, r._change_type) for r in t.read_changes(1).collect()) == [
            (2, "update_postimage"), (2, "update_preimage"), (3, "insert")]
        plan = _plan(M.upsert_frame(t.read(0), src, ["k"]), capsys)
        assert "SortMergeJoin LeftAnti" in plan and "BroadcastHashJoin" not in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
