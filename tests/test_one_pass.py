"""One-pass ingest, per-column CDC fold, runtime pruning and filters, single-join merge, the
feed in SQL, ingestion contracts, and streams that survive bad lines."""
import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from refinery.contracts import Contract
from refinery.operators import merge as M
from refinery.operators.incremental import aggregate_groups
from refinery.operators.joins import written
from refinery.operators.latest import latest_per_key
from refinery.plans import roles as R
from refinery.plans.ingestion import IngestionContract, IngestionError, plan
from refinery.plans.pipeline import SalesPipeline
from refinery.sources.tables import IngestTable, TableError, VersionedTable
from refinery.streaming import hourly as H
from refinery.streaming import ingest as S

from conftest import SF

AT = dt.datetime(2024, 1, 1, 6)
EVENTS = "event_id long, ts timestamp_ntz, event_type string, value double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


# ---- ingest ----------------------------------------------------------------
def test_ingest_is_one_job_and_rerunnable(spark, tmp_root):
    p = SalesPipeline(spark, tmp_root)
    sales = R.sales_landing(R.load(spark, SF, "lineitem")).limit(50).cache()
    p.land(sales, "a")
    p.land(sales.limit(5).withColumn("l_orderkey", F.lit(None).cast("long")), "unkeyed")
    _lines(spark, f"{p.landing}/bad", ["{broken", "no json"])
    for _ in range(2):
        p.ingest_bronze(AT, AT.date())
        assert p.bronze.read().count() == 50
        assert sorted((r.reason, r.source_file is not None) for r in p.bronze.rejected().collect()) == (
            [("corrupt line", True)] * 2 + [("null l_orderkey", True)] * 5)
    # rejects that are no longer in the landing leave with the next run of their day
    p.bronze_specs[0].source_path = f"{p.landing}/a"
    p.ingest_bronze(AT, AT.date())
    assert p.bronze.rejected().count() == 0 and p.bronze.read().count() == 50
    log = spark.read.parquet(p.ops_log).select("rows", "message").distinct().collect()
    assert {tuple(r) for r in log} == {(50, "rejected=7"), (50, "rejected=0")}


def test_ingest_keeps_rows_that_do_not_fit(spark, tmp_root):
    c = Contract.from_dict({"name": "t", "columns": [
        {"name": "k", "type": "LONG", "nullable": False}, {"name": "n", "type": "INTEGER"}, {"name": "d", "type": "DATE"},
        {"name": "_ingested_date", "type": "DATE"}]})
    t = IngestTable(spark, f"{tmp_root}/t", contract=c)
    rows = spark.createDataFrame([("1", 2.0, "2024-01-01", "f"), (None, 2.0, None, "f"), ("x", 1.0, None, "f"),
                                  ("2", 1.5, None, "f"), ("3", None, "01/02/2024", "f")],
                                 "k string, n double, d string, _source_file string")
    t.schema = type(t.schema)(t.schema.fields + rows.schema.fields[-1:])
    t.ingest(rows, AT.date())
    assert [tuple(r)[:3] for r in t.read().collect()] == [(1, 2, dt.date(2024, 1, 1))]
    assert sorted(r.reason for r in t.rejected().collect()) == [
        "d is no date", "k is no bigint", "n has a fraction", "null k"]


def test_touched_dates_build_keeps_unparseable_dates(spark, tmp_root):
    p = SalesPipeline(spark, tmp_root)
    sales = R.sales_landing(R.load(spark, SF, "lineitem")).limit(40)
    p.run(sales, AT)
    assert p.rejected_sales.read().count() == 0
    later = AT + dt.timedelta(days=1)
    p.land(sales.limit(3).withColumn("l_shipdate", F.lit("soon")).withColumn("l_orderkey", -F.col("l_orderkey")), "d2")
    p.bronze_specs[0].source_path = f"{p.landing}/d2"
    p.ingest_bronze(later, later.date())
    p.promote_silver(later, ingested_since=later.date())
    p.build_gold(later, spark.createDataFrame([(dt.date(1996, 1, 1),)], "fecha date"))
    assert [r.reason for r in p.rejected_sales.read().collect()] == ["unparseable date"] * 3
    assert spark.read.parquet(p.ops_log).where("message = 'touched dates, rejected=3'").count() == 1


# ---- CDC -------------------------------------------------------------------
CHANGES = "k long, a string, b long, op_type string, _seq long"
TARGET = "k long, a string, b long, _seq long, is_deleted boolean, _column_seq map<string,bigint>"


def _fold(records):
    """The row a key ends with: walk the sequences, a delete overlays what it carries."""
    a = b = None
    gone, last = None, None
    for _, x, y, op, seq in sorted(records, key=lambda r: r[4]):
        if op == "D":
            a, b = (a if x is None else x), (b if y is None else y)
        else:
            a, b = x, y
        gone, last = op == "D", seq
    return a, b, last, gone


@pytest.mark.parametrize("records", [
    [(1, "A", 1, "I", 1), (1, None, None, "D", 2)],
    [(1, "A", 1, "I", 1), (1, "B", None, "U", 3), (1, None, None, "D", 4)],
    [(1, "A", 1, "I", 1), (1, None, 9, "D", 2), (1, None, None, "D", 5), (1, "C", None, "U", 4)],
    [(1, None, 7, "D", 3), (1, "A", 1, "I", 1), (1, "Z", None, "D", 2), (1, "R", 2, "I", 6)],
])
def test_cdc_ends_alike_in_every_order_of_arrival(spark, records):
    want = _fold(records)
    orders = list(itertools.permutations(records))
    for order in orders[:2] + orders[2::5]:
        target = spark.createDataFrame([], TARGET)
        for record in order:
            changes = spark.createDataFrame([record], CHANGES)
            target = spark.createDataFrame(M.cdc_merge_frame(target, changes, ["k"]).collect(), TARGET)
        (row,) = target.collect()
        assert (row.a, row.b, row._seq, row.is_deleted) == want, order


def test_cdc_batches_of_any_cut_end_alike(spark):
    rng = random.Random(2)
    records = [(k, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), rng.choice("IUDD"), seq)
               for k in range(40) for seq in rng.sample(range(1, 30), 6)]
    want = {k: _fold([r for r in records if r[0] == k]) for k in range(40)}
    for cut in range(2):
        rng.shuffle(records)
        target = spark.createDataFrame([], TARGET)
        for part in (records[:70], records[70:150], records[150:], records[:20]):      # a replay last
            frame = M.cdc_merge_frame(target, spark.createDataFrame(part, CHANGES), ["k"])
            target = spark.createDataFrame(frame.collect(), TARGET)
        assert {r.k: (r.a, r.b, r._seq, r.is_deleted) for r in target.collect()} == want, cut


# ---- pruning, filters, merge -----------------------------------------------
def test_propagate_prunes_folders_of_other_groups(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", contract=R.SILVER_ORDERS)
    rows = R.orders_rows(R.load(spark, SF, "orders")).withColumn("_updated_at", F.lit(AT))
    t.overwrite(rows)
    groups, n = written(rows.where("o_orderstatus = 'P'"), ["o_orderstatus"])
    agg = aggregate_groups(t.read(), ["o_orderstatus"], groups, "o_units", "o_totalprice")
    assert n == 1 and "dynamicpruning" in _plan(agg)
    whole = rows.where("o_orderstatus = 'P'").agg(F.count("*"), F.sum("o_units")).first()
    assert [tuple(r)[:3] for r in agg.collect()] == [("P", *whole)]


def test_large_key_sets_filter_the_table_before_its_shuffle(spark, tmp_root):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    t = VersionedTable(spark, f"{tmp_root}/t", contract=R.SILVER_ORDERS)
    rows = R.orders_rows(R.load(spark, SF, "orders")).withColumn("_updated_at", F.lit(AT))
    t.overwrite(rows)
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keys, n = written(rows.where("o_orderkey % 50 = 0"), ["o_orderkey"])
        gone = M.delete_changes(t.read(), ["o_orderkey"], keys)
        assert "might_contain" in _plan(gone)
        assert gone.count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_full_merge_shuffles_each_side_once(spark, tmp_root):
    cols = "k long, v string, at long"
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], cols))
    source = spark.createDataFrame([(2, "B", 2), (2, "b", 1), (4, "d", 1), (3, "c", 1)], cols)
    latest = latest_per_key(source, ["k"], ["at"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = _plan(M.full_outer_merge(t.read(), latest, ["k"]))
        assert text.count("Exchange hashpartitioning") == 2 and "FullOuter" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    t.merge_latest(latest)
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a", 1), (2, "B", 2), (3, "c", 1), (4, "d", 1)]
    feed = t.read_changes(1).groupBy(M.CHANGE_TYPE).count().collect()
    assert {tuple(r) for r in feed} == {("insert", 1), ("update_preimage", 1), ("update_postimage", 1)}


# ---- the feed in SQL, versions ---------------------------------------------
def test_feed_function_reads_only_its_folders(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    for v in range(4):
        t.upsert(spark.createDataFrame([(v, str(v))], "k long, v string"))
    t.create_changes_function("changes")
    assert [r[0] for r in spark.sql("SELECT k FROM changes(2) ORDER BY k").collect()] == [2, 3]
    assert "_commit_version" in _plan(spark.sql("SELECT k FROM changes(3)")).split("PartitionFilters")[1][:200]
    for bad in ("0", "9", "NULL"):
        with pytest.raises(Exception, match="no change rows"):
            spark.sql(f"SELECT count(*) FROM changes({bad})").collect()


def test_a_damaged_commit_folder_is_no_missing_table(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"])
    assert not t.exists()
    t.overwrite(spark.createDataFrame([(1,)], "k long"))
    t.overwrite(spark.createDataFrame([(1,), (2,)], "k long"))
    again = VersionedTable(spark, t.path, keys=["k"])
    assert again.current_version() == 1 and again.num_rows() == 2 and again.num_rows(0) == 1
    with pytest.raises(TableError):
        VersionedTable(spark, f"{tmp_root}/none").read()


# ---- ingestion contracts ---------------------------------------------------
def _contracts(root, **changes):
    table = {"name": "x_raw", "schema": "s", "catalog": "bronze", "columns": [
        {"name": "k", "type": "LONG", "nullable": False}, {"name": "_ingested_at", "type": "TIMESTAMP"}]}
    doc = {"name": "x", "source": {"format": "json", "path": "{path.landing}/x"}, "metadata": {"add_ingested_at": True},
           "destination_contract": "t.json", **changes}
    (root / "t.json").write_text(json.dumps(table))
    folder = root / "ingestion"
    folder.mkdir(exist_ok=True)
    doc["destination_contract"] = doc["destination_contract"] and "../" + doc["destination_contract"]
    (folder / "x.json").write_text(json.dumps({k: v for k, v in doc.items() if v is not None}))
    return folder


CONFIG = {"path": {"landing": "/land"}}


def test_ingestion_contract_is_read_and_planned(tmp_path):
    (c,) = plan(_contracts(tmp_path, enabled=False), CONFIG)
    spec = c.spec()
    assert (spec.source_path, spec.enabled, spec.source_contract.names) == ("/land/x", False, ["k"])


@pytest.mark.parametrize("changes, message", [
    ({"name": None}, "lacks name"), ({"load_type": "odd"}, "load_type"), ({"ingest_type": "odd"}, "ingest_type"),
    ({"source": {"format": "avro", "path": "p"}}, "format"), ({"source": {"format": "json"}}, "source.path"),
    ({"metadata": {"add_source_file": True}}, "audit columns"), ({"destination_contract": "no.json"}, "does not exist"),
    ({"source": {"format": "json", "path": "{path.nowhere}"}}, "no config value"),
    ({"source_contract": "../t.json", "strategy": "odd"}, "strategy"),
    ({"source_contract": "../t.json", "strategy": "full_merge", "merge_keys": ["z"], "watermark_col": "k"}, "merge_keys"),
])
def test_faulty_ingestion_contracts_are_refused(tmp_path, changes, message):
    folder = _contracts(tmp_path, **changes)
    with pytest.raises(IngestionError, match=message):
        IngestionContract.load(folder / "x.json", CONFIG)


# ---- streams ---------------------------------------------------------------
def test_hourly_survives_bad_batches(spark, tmp_root):
    gold = VersionedTable(spark, f"{tmp_root}/gold", keys=H.HOURLY_KEYS)
    args = (spark, f"{tmp_root}/landing", EVENTS, gold, f"{tmp_root}/ckpt")
    _lines(spark, f"{tmp_root}/landing/a", ["{bad", '{"event_id": 1, "ts": null, "event_type": "x", "value": 1}'])
    assert H.run_hourly(*args) == {"rows": 2, "late": 0, "rejected": 2} and not gold.exists()
    good = '{"event_id": %d, "ts": "2024-01-01T0%d:10:00.000000", "event_type": %s, "value": 1.5}'
    _lines(spark, f"{tmp_root}/landing/b", [good % (2, 1, '"x"'), good % (3, 1, "null"), good % (4, 2, '"y"')])
    assert H.run_hourly(*args)["rejected"] == 1
    _lines(spark, f"{tmp_root}/landing/c", [good % (5, 1, "null"), good % (6, 1, '"x"')])
    assert H.run_hourly(*args) == {"rows": 2, "late": 1, "rejected": 1}
    assert sorted((r.event_type, r.n) for r in gold.read().collect()) == [("x", 2), ("y", 1)]
    assert sorted(r.reason for r in H.rejected_events(spark, gold, EVENTS).collect()) == [
        "corrupt line", "no time", "no type", "no type"]


def test_dedup_counts_rows_later_than_its_delay(spark, tmp_root):
    bronze = f"{tmp_root}/bronze"
    args = dict(dedup_keys=["event_id"], event_time="ts", delay="1 hour")
    line = '{"event_id": %s, "ts": "2024-01-%02dT05:00:00.000000", "event_type": "x", "value": 1}'
    _lines(spark, f"{tmp_root}/landing/a", [line % (1, 5), line % (1, 5), line % ("null", 5), "{bad"])
    n = S.ingest_available(spark, f"{tmp_root}/landing", EVENTS, bronze, f"{tmp_root}/ckpt", **args)
    assert (n["kept"], n["rejected"], n["late"]) == (2, 1, 0)
    _lines(spark, f"{tmp_root}/landing/b", [line % (1, 5), line % (2, 5), line % (3, 1)])
    n = S.ingest_available(spark, f"{tmp_root}/landing", EVENTS, bronze, f"{tmp_root}/ckpt", **args)
    assert (n["kept"], n["late"]) == (1, 1)
    assert S.read_rejected(spark, bronze).count() == 1


def test_a_replayed_micro_batch_replaces_its_own(spark, tmp_root):
    bronze = f"{tmp_root}/bronze"
    for i in range(3):
        _lines(spark, f"{tmp_root}/landing/{i}", ['{"event_id": %d}' % i])
    n = S.ingest_available(spark, f"{tmp_root}/landing", EVENTS, bronze, f"{tmp_root}/ckpt", max_files_per_trigger=1)
    assert n["batches"] == 3
    # the same backlog once more from an empty checkpoint writes the same batch folders
    S.ingest_available(spark, f"{tmp_root}/landing", EVENTS, bronze, f"{tmp_root}/ckpt2", max_files_per_trigger=1)
    assert sorted(r.event_id for r in S.read_bronze(spark, bronze).collect()) == [0, 1, 2]
