"""Named queries over the driver's test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the whole given tables (or what Spark derives from them).
Queries that exercise writes (versions, merges, the feed, streams) run their
pipeline into a fresh folder below the session's checkpoint directory and
return a DataFrame over what was written. Time stamps are left out of every
result except ``recalc_order``, where fixed stamps make it reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
import datetime as dt
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery import contracts
from refinery.functions.money import from_cents
from refinery.operators import incremental as inc
from refinery.operators import merge as M
from refinery.operators import quality as Q
from refinery.plans import reports as RP
from refinery.plans import roles as R
from refinery.plans.cdc import CustomersCase
from refinery.plans.changefeed import OrdersCase, run_standard, seeded_case, stamp_at
from refinery.plans.gold import KPI_COLUMNS, compute_kpis
from refinery.plans.ingestion import pipeline_from
from refinery.plans.pipeline import SalesPipeline
from refinery.session import work_dir
from refinery.sources.files import add_ingest_metadata, read_jsonl, write_jsonl
from refinery.sources.tables import OPS_DDL, IngestTable, TableError, VersionedTable
from refinery.streaming import hourly as H
from refinery.streaming import ingest as S

Query = Callable[[SparkSession, str], DataFrame]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
              "o_units", "o_totalprice"]
SALES_COLS = [c.name for c in R.LANDING_SALES.columns]
EVENT_DDL = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
             "value double, props string")
DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
STREAM_SPLIT = dt.datetime(2024, 1, 16)
CONTRACTS = Path(__file__).parent / "plans" / "contracts"


# ---- batch sales ---------------------------------------------------------
def kpi_daily(spark, sf):
    """A1 over the sales role."""
    return compute_kpis(R.load(spark, sf, "lineitem"), **R.SALES_ROLE).select(*KPI_COLUMNS)


def bronze_jsonl_roundtrip(spark, sf):
    """K12 -> S1 -> P1: sales written as JSON Lines, read back with the contract."""
    root = work_dir(spark, "jsonl")
    write_jsonl(R.sales_landing(R.load(spark, sf, "lineitem")), f"{root}/landing/a")
    df = add_ingest_metadata(read_jsonl(spark, f"{root}/landing", R.LANDING_SALES.schema))
    return df.where(F.col("_corrupt_record").isNull()).select(*SALES_COLS)


def bronze_day_overwrite(spark, sf):
    """K1 + K2: a day re-ingested replaces its partition; the unpartitioned table appends."""
    root = work_dir(spark, "bronze_day")
    p = SalesPipeline(spark, root)
    p.land(R.sales_landing(R.load(spark, sf, "lineitem")))
    at1, at2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    p.ingest_bronze(at1, DAY1)
    p.ingest_bronze(at1, DAY1)          # same-day re-run: replaced, not duplicated
    p.ingest_bronze(at2, DAY2)
    appended = IngestTable(spark, f"{root}/bronze/batch/ventas_append", contract=R.BRONZE_SALES, partitioned=False)
    p.ingest_bronze(at1, DAY1, table=appended)
    p.ingest_bronze(at1, DAY1, table=appended)   # no partition column: appends
    part = p.bronze.read().withColumn("table_kind", F.lit("partitioned"))
    app = appended.read().withColumn("table_kind", F.lit("append"))
    return (part.select("table_kind", "_ingested_date").unionByName(
                app.select("table_kind", "_ingested_date"))
            .groupBy("table_kind", "_ingested_date").agg(F.count(F.lit(1)).alias("n_rows")))


def _pipeline(spark, sf, name) -> SalesPipeline:
    p = SalesPipeline(spark, work_dir(spark, name))
    return p.run(R.sales_landing(R.load(spark, sf, "lineitem")), dt.datetime(2024, 1, 1, 6))


def _corrections(sales: DataFrame) -> DataFrame:
    """Day-2 re-emissions: same key and date, the amount corrected by one."""
    return (sales.where(F.col("l_orderkey") % 11 == 0)
            .withColumn("l_extendedprice", F.col("l_extendedprice") - 1.0))


def _two_days(spark, sf, name: str, incremental: bool) -> SalesPipeline:
    """Sales land on two days, split by ship date (every row lands); day 2 also corrects
    day-1 keys. Then day 1 is landed and promoted once more: its old copies must lose."""
    p = SalesPipeline(spark, work_dir(spark, name))
    sales = R.sales_landing(R.load(spark, sf, "lineitem"))
    first = F.coalesce(F.col("l_shipdate") < F.lit("1998-01-01"), F.lit(False))
    at1, at2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    p.land(sales.where(first), "d1")
    p.bronze_specs[0].source_path = f"{p.landing}/d1"
    p.ingest_bronze(at1, DAY1)
    if incremental:
        p.promote_silver(at1)
    p.land(sales.where(~first).unionByName(_corrections(sales)), "d2")
    p.bronze_specs[0].source_path = f"{p.landing}/d2"
    p.ingest_bronze(at2, DAY2)
    p.promote_silver(at2, ingested_since=DAY2 if incremental else None)
    if incremental:
        p.bronze_specs[0].source_path = f"{p.landing}/d1"
        p.ingest_bronze(at1, DAY1)
        p.promote_silver(at2, ingested_since=DAY1)
    return p


def silver_full_merge(spark, sf):
    """W1 + K6 + P2: two ingestions, Bronze -> Silver in one promotion: the version
    ingested last wins, within one ingestion the latest ship date."""
    return _two_days(spark, sf, "silver", False).silver.read().select(*SALES_COLS)


def silver_incremental_merge(spark, sf):
    """S3 + K6 incremental: day 2 is promoted from its own Bronze partition only, and an
    old copy promoted later loses; equal to the full promotion."""
    return _two_days(spark, sf, "silver_inc", True).silver.read().select(*SALES_COLS)


def two_contracts_bronze(spark, sf):
    """E1 + S3: two ingestion contracts, loaded from a folder, on one day: each has its own
    table, both complete."""
    root = work_dir(spark, "two")
    p = SalesPipeline(spark, root)
    sales = R.sales_landing(R.load(spark, sf, "lineitem"))
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    p.land(sales.where(~returned), "main")
    p.bronze_specs[0].source_path = f"{p.landing}/main"
    write_jsonl(sales.where(returned), f"{root}/landing/devoluciones/a")
    other = replace(R.BRONZE_SALES, name="devoluciones_raw")
    spec = p.add_bronze_spec("devoluciones", f"{root}/landing/devoluciones", R.LANDING_SALES, other)
    p.ingest_bronze(dt.datetime(2024, 1, 1, 6), DAY1)
    return p.bronze.read().select(F.lit("ventas").alias("spec"), *SALES_COLS).unionByName(
        p.bronze_table(spec.destination).read().select(F.lit("devoluciones").alias("spec"), *SALES_COLS))


def quarantine_counts(spark, sf):
    """Q5: no row is lost. Planted corrupt lines, null keys, unparseable dates and bad change
    operations: rows in = rows kept + rows rejected, per step. Every step runs twice: a re-run
    replaces what the first run kept and rejected."""
    root = work_dir(spark, "quarantine")
    p = SalesPipeline(spark, root)
    sales = R.sales_landing(R.load(spark, sf, "lineitem"))
    p.land(sales.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 7 == 0, F.lit("31/12/2024"))
                            .otherwise(F.col("l_shipdate"))), "good")
    bad = sales.where(F.col("l_orderkey") % 5 == 0).select(
        F.concat(F.lit("{not json "), F.col("l_orderkey").cast("string")).alias("value"))
    bad.write.text(f"{p.landing}/bad")
    p.land(sales.where(F.col("l_orderkey") % 23 == 0).withColumn("l_orderkey", F.lit(None).cast("long")), "unkeyed")
    at = dt.datetime(2024, 1, 1, 6)
    for _ in range(2):
        p.ingest_bronze(at, DAY1)
        p.promote_silver(at)
        p.build_gold(at)
    case = _cdc_case(spark, sf, "quarantine_cdc")
    case.merge_silver(case.ingest_bronze(f"{case.landing}/b1", dt.datetime(2024, 1, 3, 6)))

    def total(df: DataFrame, step: str, kind: str, n=F.count(F.lit(1))) -> DataFrame:
        return df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n")).select(
            F.lit(step).alias("step"), F.lit(kind).alias("kind"), "n")
    parts = [total(p.bronze.read(), "ingest", "kept"),
             total(p.bronze.rejected(), "ingest", "rejected"),
             total(p.gold.read(), "gold", "kept", F.sum("num_ventas")),
             total(p.rejected_sales.read(), "gold", "rejected"),
             total(case.bronze.read(), "changes", "kept"),
             total(case.bronze.rejected(), "changes", "rejected")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def gold_touched_dates(spark, sf):
    """E3 incremental: after day 2 only the dates it touched are recomputed in Gold."""
    p = SalesPipeline(spark, work_dir(spark, "gold_dates"))
    sales = R.sales_landing(R.load(spark, sf, "lineitem"))
    first = F.coalesce(F.col("l_shipdate") < F.lit("1998-01-01"), F.lit(False))
    at1, at2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    for part, name, at in ((sales.where(first), "d1", at1),
                           (sales.where(~first).unionByName(_corrections(sales)), "d2", at2)):
        before = p.silver.read().select("l_orderkey", "l_linenumber", "l_shipdate") if p.silver.exists() else None
        p.land(part, name)
        p.bronze_specs[0].source_path = f"{p.landing}/{name}"
        p.ingest_bronze(at, at.date())
        p.promote_silver(at, ingested_since=at.date())
        if before is None:
            p.build_gold(at)
        else:       # the dates of the new rows and those that the replaced rows had
            keys = p.bronze.read().where(F.col("_ingested_date") == F.lit(at.date())).select(*R.SALES_KEYS)
            dates = (before.join(keys, R.SALES_KEYS, "left_semi").select("l_shipdate")
                     .unionByName(p.silver.read().join(keys, R.SALES_KEYS, "left_semi").select("l_shipdate"))
                     .select(F.to_date("l_shipdate").alias("fecha")))
            p.build_gold(at, dates)
    return p.gold.read().select(*KPI_COLUMNS)


def layer_counts(spark, sf):
    """U1 + A12 + Q6: rows per layer after a full pipeline run; Silver and Gold from their
    commit rows, so none of their data is read."""
    p = _pipeline(spark, sf, "layers")
    return Q.layer_counts({"Bronze": p.bronze.read(), "Silver": p.silver.num_rows(), "Gold": p.gold.num_rows()})


def operations_log(spark, sf):
    """Rows, status and note that each step of a two-day run with a correction wrote."""
    p = _two_days(spark, sf, "ops_log", True)
    p.build_gold(dt.datetime(2024, 1, 2, 6))
    log = spark.read.schema(OPS_DDL).parquet(p.ops_log)
    return (log.groupBy("step", "target", "status", "message")
            .agg(F.count(F.lit(1)).alias("runs"), F.max("rows").alias("most_rows")))


def contract_ingestion(spark, sf):
    """S1 + S3 + E1 + E2 + E6 + K6: a pipeline made from JSON ingestion contracts alone (one
    landing, one promotion, one landing that is switched off and whose source is missing)."""
    root = work_dir(spark, "contracts")
    config = {"path": {"landing": f"{root}/landing"}, "catalog": {"bronze": "bronze", "silver": "silver"}}
    p = pipeline_from(spark, root, f"{CONTRACTS}/ingestion", config)
    write_jsonl(R.sales_landing(R.load(spark, sf, "lineitem")), f"{root}/landing/lineas/a", compact=True)
    for at in (dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)):
        p.ingest_bronze(at, at.date())
        p.promote_silver(at)
    (spec,) = p.silver_specs
    return p.silver_table(spec.destination).read().select(*SALES_COLS)


def kpi_detail(spark, sf):
    """P5: the Gold KPI table written by the pipeline (over deduplicated Silver)."""
    return RP.kpi_detail(_pipeline(spark, sf, "kpi_detail").gold.read())


def _gold(spark, sf, name) -> DataFrame:
    """The Gold KPI table that the pipeline writes (A7, A8 read it as the dashboard does)."""
    return _pipeline(spark, sf, name).gold.read()


def revenue_total(spark, sf):
    return RP.revenue_total(_gold(spark, sf, "revenue"))


def units_total(spark, sf):
    return RP.units_total(_gold(spark, sf, "units"))


def ticket_mean(spark, sf):
    return RP.ticket_mean(_gold(spark, sf, "ticket"))


def revenue_by_day(spark, sf):
    return RP.revenue_by(_gold(spark, sf, "by_day"), "fecha")


def revenue_by_category(spark, sf):
    return RP.revenue_by(_gold(spark, sf, "by_category"), "categoria")


def revenue_by_channel(spark, sf):
    return RP.revenue_by(_gold(spark, sf, "by_channel"), "canal")


def kpi_filtered(spark, sf):
    """SQL-string predicate with AND and an IS NULL test."""
    return RP.kpi_filtered(compute_kpis(R.load(spark, sf, "lineitem"), **R.SALES_ROLE),
                           "categoria = 'R' AND canal = 'F' AND NOT (ticket_medio IS NULL)")


# ---- change feed: orders -------------------------------------------------
def _orders(spark, sf):
    return R.orders_rows(R.load(spark, sf, "orders"))


def upsert_orders(spark, sf):
    """Inserts and valid updates of the batch merged into the orders."""
    rows = _orders(spark, sf)
    b = R.valid_batch(rows)
    return M.upsert_frame(rows, b["inserts"].unionByName(b["updates"]), R.ORDER_KEYS)


def delete_orders(spark, sf):
    """K5: the batch's deletes, by key frame."""
    rows = _orders(spark, sf)
    return M.delete_frame(rows, R.ORDER_KEYS, keys_df=R.proposed_batch(rows)["deletes"])


def apply_change_batch(spark, sf):
    """K8: seed (v0), then inserts, updates, deletes as versions 1..3."""
    case = run_standard(spark, work_dir(spark, "apply"), R.load(spark, sf, "orders"), False)
    return case.source.read().select(*ORDER_COLS)


def apply_batch_single_commit(spark, sf):
    """K8 as one version: the whole batch in one rewrite of the table."""
    case, rows = seeded_case(spark, work_dir(spark, "apply1"), R.load(spark, sf, "orders"))
    case.apply_batch(R.valid_batch(case.source.read(0).drop("_updated_at")), stamp_at(2),
                     single_commit=True)
    return case.source.read().select(*ORDER_COLS)


def _feed_case(spark, sf, name) -> OrdersCase:
    return run_standard(spark, work_dir(spark, name), R.load(spark, sf, "orders"), False)


def change_feed_rows(spark, sf):
    """F1 + K13 + S4: change rows of versions 1..3."""
    case = _feed_case(spark, sf, "feed")
    return case.source.read_changes(1, 3).select(*ORDER_COLS, M.CHANGE_TYPE, "_commit_version")


def change_type_counts(spark, sf):
    """A13 + S5: open-ended feed read, rows per change type."""
    case = _feed_case(spark, sf, "feed_counts")
    return inc.change_type_counts(case.source.read_changes(1))


def changes_function(spark, sf):
    """The feed as a SQL table function, from the first and from the second version."""
    case = _feed_case(spark, sf, "feed_sql")
    case.source.create_changes_function("changes")
    return spark.sql("SELECT 1 AS since, _change_type, count(*) AS n FROM changes(1) GROUP BY _change_type "
                     "UNION ALL SELECT 2, _change_type, count(*) FROM changes(2) GROUP BY _change_type")


def feed_refused(spark, sf):
    """reads of the feed that must be refused, beside one that is whole."""
    case = _feed_case(spark, sf, "feed_refused")
    rows = []
    for name, bounds in (("from version 0", (0, 3)), ("beyond the newest", (1, 4)), ("empty range", (3, 2)),
                         ("whole", (1, 3))):
        try:
            rows.append((name, False, case.source.read_changes(*bounds).count()))
        except TableError:
            rows.append((name, True, 0))
    return spark.createDataFrame(rows, "range string, refused boolean, change_rows long")


def feed_gap_rebuild(spark, sf):
    """the middle one of three versions has no change rows (the feed was off), so the next
    propagate rebuilds Gold; one more batch with the feed on is incremental again."""
    case, rows = seeded_case(spark, work_dir(spark, "feed_gap"), R.load(spark, sf, "orders"))
    modes = [case.propagate(stamp=stamp_at(1)).mode]
    batch = R.valid_batch(case.source.read(0).drop("_updated_at"))
    case.apply_batch({"updates": batch["updates"]}, stamp_at(2))
    case.source.change_feed = False
    case.apply_batch({"inserts": batch["inserts"]}, stamp_at(3))
    case.source.change_feed = True
    modes.append(case.propagate(stamp=stamp_at(4)).mode)
    case.apply_batch({"deletes": batch["deletes"]}, stamp_at(5))
    modes.append(case.propagate(stamp=stamp_at(6)).mode)
    return case.gold.read().select(R.ORDER_GROUP, *inc.AGG_COLUMNS, F.lit(",".join(modes)).alias("modes"))


def distinct_groups(spark, sf):
    """A5: the groups of the table itself, rows without one left out."""
    return inc.distinct_groups(_narrow_case(spark, sf, "groups").source.read(), [R.ORDER_GROUP])


def _narrow_case(spark, sf, name) -> OrdersCase:
    """A seeded case whose feed touches two of the three states, and rows without a state:
    some 'O' orders become 'P' in version 1, some orders lose their state before."""
    case = OrdersCase(spark, work_dir(spark, name))
    rows = _orders(spark, sf).withColumn(R.ORDER_GROUP, F.when(F.col("o_orderkey") % 29 == 0, F.lit(None))
                                         .otherwise(F.col(R.ORDER_GROUP)))
    case.seed(rows, stamp_at(0))
    k = F.col("o_orderkey")
    moved = rows.where((F.col(R.ORDER_GROUP) == "O") & (k % 10 == 0)).withColumn(R.ORDER_GROUP, F.lit("P"))
    unnamed = rows.where(F.col(R.ORDER_GROUP).isNull() & (k % 2 == 0)).withColumn(R.ORDER_UNITS, F.lit(9))
    case.apply_batch({"updates": moved.unionByName(unnamed)}, stamp_at(1))
    return case


def affected_groups(spark, sf):
    """A3 + P8: groups touched by the feed, pre-images included, rows without a group left out."""
    case = _narrow_case(spark, sf, "affected")
    return inc.affected_groups(case.source.read_changes(1, 1), [R.ORDER_GROUP])


def recompute_affected(spark, sf):
    """A2 + J3 + P7 + P8: the aggregate of the affected groups only (two of three states)."""
    case = _narrow_case(spark, sf, "recompute")
    groups = inc.affected_groups(case.source.read_changes(1, 1), [R.ORDER_GROUP])
    return inc.aggregate_groups(case.source.read(), [R.ORDER_GROUP], groups,
                                R.ORDER_UNITS, R.ORDER_AMOUNT).drop("_recalculado_at")


def emptied_groups(spark, sf):
    """A4 + J2 + U2: with the city as group, a delete of all of '5-LOW' empties it."""
    case = _feed_case(spark, sf, "emptied")
    case.delete_where("o_orderpriority = '5-LOW'", stamp_at(4))
    groups = inc.affected_groups(case.source.read_changes(1, 4), [R.ORDER_CITY])
    fresh = inc.aggregate_groups(case.source.read(), [R.ORDER_CITY], groups,
                                 R.ORDER_UNITS, R.ORDER_AMOUNT)
    return inc.emptied_groups(fresh, groups, [R.ORDER_CITY])


def _incremental_case(spark, sf, name) -> OrdersCase:
    case = run_standard(spark, work_dir(spark, name), R.load(spark, sf, "orders"), True)
    res = case.propagate(stamp=stamp_at(5))          # F4: nothing new, nothing written
    if res.mode != "noop":
        raise RuntimeError(f"a propagate with no new version must be a no-op, got {res}")
    return case


def incremental_aggregate(spark, sf):
    """F2 + F3 + F4 + K9: cold start, batch, incremental propagate."""
    case = _incremental_case(spark, sf, "incremental")
    return case.gold.read().select(R.ORDER_GROUP, *inc.AGG_COLUMNS)


def full_aggregate(spark, sf):
    """The full recompute the incremental result must equal (bench baseline)."""
    case = _feed_case(spark, sf, "full")
    return inc.aggregate_groups(case.source.read(), [R.ORDER_GROUP], None,
                                R.ORDER_UNITS, R.ORDER_AMOUNT).drop("_recalculado_at")


def delta_aggregate(spark, sf):
    """Cold aggregate of v0 plus the signed feed of 1..3."""
    case = _feed_case(spark, sf, "delta")
    prev = inc.aggregate_groups(case.source.read(0), [R.ORDER_GROUP], None,
                                R.ORDER_UNITS, R.ORDER_AMOUNT)
    return inc.delta_aggregate(prev, case.source.read_changes(1, 3), [R.ORDER_GROUP],
                               R.ORDER_UNITS, R.ORDER_AMOUNT)


def control_counters(spark, sf):
    """A9 + F6 + S10 + P6 + O2 + X4: the pointer after the run."""
    case = _incremental_case(spark, sf, "control")
    return RP.control_counters(case.control.read().where(F.col("dataset") == case.dataset))


def control_detail(spark, sf):
    """P5: the control table."""
    case = _incremental_case(spark, sf, "control_detail")
    return case.control.read().select("dataset", "ultima_version", "filas_procesadas")


def aggregate_detail(spark, sf):
    """P5: the Gold aggregate table."""
    case = _incremental_case(spark, sf, "aggregate_detail")
    return case.gold.read().select(R.ORDER_GROUP, *inc.AGG_COLUMNS)


def orders_in_force(spark, sf):
    return RP.orders_in_force(_incremental_case(spark, sf, "in_force").gold.read())


def orders_by_state(spark, sf):
    return RP.orders_by_state(_incremental_case(spark, sf, "by_state").gold.read(), R.ORDER_GROUP)


def revenue_by_state(spark, sf):
    return RP.revenue_by_state(_incremental_case(spark, sf, "rev_state").gold.read(),
                               R.ORDER_GROUP)


def orders_by_city(spark, sf):
    """A11 over the source table after the batch."""
    return RP.orders_by_city(_feed_case(spark, sf, "city").source.read(), R.ORDER_CITY)


def recalc_order(spark, sf):
    """O1: a second pass that only touches 'F' recomputes only 'F' (newest stamp)."""
    case, _ = seeded_case(spark, work_dir(spark, "recalc"), R.load(spark, sf, "orders"))
    case.propagate(stamp=stamp_at(1))
    case.delete_where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'", stamp_at(2))
    case.propagate(stamp=stamp_at(3))
    return RP.recalc_order(case.gold.read(), R.ORDER_GROUP)


# ---- quality -------------------------------------------------------------
def transition_violations(spark, sf):
    """Q1 + J4: proposed updates whose state change is not allowed."""
    rows = _orders(spark, sf)
    b = R.proposed_batch(rows)
    return Q.transition_violations(b["updates"], rows, R.ORDER_KEYS, R.ORDER_GROUP,
                                   R.ORDER_TRANSITIONS)


def amount_violations(spark, sf):
    """Q2 + X5: amount vs quantity x unit price, with amounts written from a price list
    (90,000 + part key cents) and every 97th order off by a cent."""
    li = R.load(spark, sf, "lineitem")
    price = F.lit(90_000) + F.col("l_partkey")
    wrong = F.when(F.col("l_orderkey") % 97 == 0, 1).otherwise(0)
    sold = li.withColumn("amount", from_cents(F.col("l_quantity").cast("long") * price + wrong))
    return Q.amount_violations(sold, R.SALES_KEYS + ["l_partkey"], "l_quantity", price, "amount")


def batch_conflicts(spark, sf):
    """Q3 + U3: keys both updated and deleted; inserts reusing a key."""
    rows = _orders(spark, sf)
    b = R.proposed_batch(rows)
    reused = rows.where(F.col("o_orderkey") % 41 == 5)       # planted: keys that exist
    return Q.batch_conflicts(b["inserts"].unionByName(reused), b["updates"], b["deletes"], rows, R.ORDER_KEYS)


def duplicate_keys(spark, sf):
    """Q4: re-emitted sale keys and their copies."""
    return Q.duplicate_keys(R.load(spark, sf, "lineitem"), R.SALES_KEYS)


def reemission_count(spark, sf):
    """Q4: rows, distinct keys, re-emitted rows."""
    return Q.reemission_count(R.load(spark, sf, "lineitem"), R.SALES_KEYS)


def contract_check(spark, sf):
    """Q5 + K11: the orders role, with planted text that is no number and no date, against
    the Silver orders contract."""
    k = F.col("o_orderkey")
    planted = _orders(spark, sf).withColumns({
        "o_totalprice": F.when(k % 31 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
        "o_orderdate": F.when(k % 37 == 0, F.lit("31/12/2024")).otherwise(F.col("o_orderdate").cast("string"))})
    return contracts.check(planted, R.SILVER_ORDERS)


# ---- CDC customers -------------------------------------------------------
def _cdc_case(spark, sf, name) -> CustomersCase:
    """Two landing batches arriving out of order: deletes and revivals first,
    then the inserts and updates they supersede. Deletes that carry only their key come before
    the updates whose values they keep."""
    case = CustomersCase(spark, work_dir(spark, name))
    customer = R.load(spark, sf, "customer")
    changes = R.customer_changes(customer)
    bare, older = R.key_only_deletes(customer)
    late = case.land(changes.where(F.col("_seq") >= 3).unionByName(R.planted_changes(customer)).unionByName(bare), "b1")
    early = case.land(changes.where(F.col("_seq") < 3).unionByName(older), "b2")
    for i, path in enumerate([late, early]):
        at = dt.datetime(2024, 1, 1 + i, 6)
        case.merge_silver(case.ingest_bronze(path, at), at)
    return case


def cdc_soft_delete(spark, sf):
    """S9 + C1 + K7 + C2: final customers with soft-delete flags."""
    silver = _cdc_case(spark, sf, "cdc").silver.read()
    return silver.withColumn("deleted_at", F.col("deleted_at").cast("timestamp_ntz")).drop("_column_seq")


def cdc_gold(spark, sf):
    """active/deleted customers and active balance per segment."""
    case = _cdc_case(spark, sf, "cdc_gold")
    case.build_gold(dt.datetime(2024, 1, 3, 6))
    return case.gold_table.read()


# ---- streaming -----------------------------------------------------------
def _land_events(spark, sf, root):
    ev = R.load(spark, sf, "events")
    first = F.coalesce(F.col("ts") < F.lit(STREAM_SPLIT), F.lit(False))
    write_jsonl(ev.where(first), f"{root}/landing/w1")
    return ev.where(~first)


def stream_ingest(spark, sf):
    """T1 + T2 + T3: two stream runs over two landing waves, each promoted to Silver
    (the second from its own micro-batches only)."""
    root = work_dir(spark, "stream")
    ev = _land_events(spark, sf, root)
    bronze, ckpt = f"{root}/bronze/events", f"{root}/_checkpoints/bronze"
    silver = VersionedTable(spark, f"{root}/silver/events", keys=["event_id"])
    S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt)
    S.promote(spark, bronze, silver, ["event_id"], "ts")
    done = S.last_batch(spark, bronze)
    write_jsonl(ev, f"{root}/landing/w2")
    S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt)
    if S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt)["kept"] != 0:
        raise RuntimeError("a third run with no new files must read nothing")
    S.promote(spark, bronze, silver, ["event_id"], "ts", after_batch=done)   # new batches only
    return silver.read().select("event_id", "ts", "user_id", "event_type", "value", "props")


def stream_drain(spark, sf):
    """S8 + T1: a backlog of five files drained two at a time (three micro-batches), with
    malformed lines among them; every row in Bronze once, also after a restart."""
    root = work_dir(spark, "drain")
    ev = R.load(spark, sf, "events")
    for i in range(4):
        write_jsonl(ev.where(F.col("event_id") % 4 == i).coalesce(1), f"{root}/landing/w{i}")
    ev.where(F.col("event_id") % 11 == 0).select(F.concat(F.lit("{bad "), "event_id").alias("value")).coalesce(1).write.text(
        f"{root}/landing/bad")
    bronze, ckpt = f"{root}/bronze/events", f"{root}/_checkpoints/bronze"
    runs = [S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt, max_files_per_trigger=2) for _ in range(2)]
    return (S.read_bronze(spark, bronze).agg(F.count(F.lit(1)).alias("kept"), F.countDistinct("event_id").alias("events"))
            .crossJoin(S.read_rejected(spark, bronze).agg(F.count(F.lit(1)).alias("rejected")))
            .select("kept", "events", "rejected", F.lit(runs[0]["batches"]).alias("batches"),
                    F.lit(runs[1]["batches"]).alias("batches_after")))


def stream_dedup(spark, sf):
    """Events emitted again, in the same wave and in the next one (after a restart), reach
    Bronze once; the state keeps five days of keys."""
    root = work_dir(spark, "dedup")
    ev = R.load(spark, sf, "events")
    first = F.coalesce(F.col("ts") < F.lit(STREAM_SPLIT), F.lit(False))
    recent = first & (F.col("ts") >= F.lit(STREAM_SPLIT - dt.timedelta(days=2)))
    bronze, ckpt = f"{root}/bronze/events", f"{root}/_checkpoints/bronze"
    args = dict(dedup_keys=["event_id"], event_time="ts", delay="5 days")
    write_jsonl(ev.where(first).unionByName(ev.where(first & (F.col("event_id") % 5 == 0))), f"{root}/landing/w1")
    S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt, **args)
    write_jsonl(ev.where(~first).unionByName(ev.where(recent & (F.col("event_id") % 3 == 0))), f"{root}/landing/w2")
    late = S.ingest_available(spark, f"{root}/landing", EVENT_DDL, bronze, ckpt, **args)["late"]
    if late:
        raise RuntimeError(f"{late} rows came more than five days late")
    return S.read_bronze(spark, bronze).select("event_id", "ts", "user_id", "event_type", "value", "props")


def stream_windows(spark, sf):
    """T4: final hourly windows from a stateful stream with a watermark, over a restart. Every
    seventh event comes a wave late: those whose window is closed by then are left out and counted."""
    root = work_dir(spark, "windows")
    ev = R.load(spark, sf, "events")
    first = F.coalesce((F.col("ts") < F.lit(STREAM_SPLIT)) & (F.col("event_id") % 7 != 0), F.lit(False))
    path, ckpt, landing = f"{root}/gold/windows", f"{root}/_checkpoints/windows", f"{root}/landing"
    write_jsonl(ev.where(first), f"{landing}/w1")
    H.run_windows(spark, landing, EVENT_DDL, path, ckpt)
    write_jsonl(ev.where(~first), f"{landing}/w2")
    closed = H.run_windows(spark, landing, EVENT_DDL, path, ckpt)
    events = read_jsonl(spark, landing, EVENT_DDL).drop("_corrupt_record")
    return (H.windows_with_late(H.read_windows(spark, path), events, closed)
            .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def stream_hourly(spark, sf):
    """T4: hourly windows per event type from the stream, final values in Gold. The first wave
    holds nothing but malformed lines and events without a type, which count in no hour."""
    root = work_dir(spark, "hourly")
    gold = VersionedTable(spark, f"{root}/gold/events_hourly", keys=H.HOURLY_KEYS)
    ckpt = f"{root}/_checkpoints/hourly"
    every = R.load(spark, sf, "events")
    every.select(F.concat(F.lit("{bad "), "event_id").alias("value")).write.text(f"{root}/landing/bad")
    write_jsonl(every.where(F.col("event_id") % 10 == 0).withColumn("event_type", F.lit(None).cast("string")),
                f"{root}/landing/untyped")
    H.run_hourly(spark, f"{root}/landing", EVENT_DDL, gold, ckpt)
    ev = _land_events(spark, sf, root)
    H.run_hourly(spark, f"{root}/landing", EVENT_DDL, gold, ckpt)
    write_jsonl(ev, f"{root}/landing/w2")
    H.run_hourly(spark, f"{root}/landing", EVENT_DDL, gold, ckpt)
    return gold.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                              "event_type", "n", "value_sum", "value_avg")


def late_events(spark, sf):
    """T4: every seventh event lands a wave late, most of them long after their hour:
    Gold still counts all of them, and the run says how many rows came late."""
    root = work_dir(spark, "late")
    ev = R.load(spark, sf, "events")
    late = F.col("event_id") % 7 == 0
    gold = VersionedTable(spark, f"{root}/gold/events_hourly", keys=H.HOURLY_KEYS)
    ckpt = f"{root}/_checkpoints/hourly"
    write_jsonl(ev.where(~late), f"{root}/landing/w1")
    first = H.run_hourly(spark, f"{root}/landing", EVENT_DDL, gold, ckpt)
    write_jsonl(ev.where(late), f"{root}/landing/w2")
    second = H.run_hourly(spark, f"{root}/landing", EVENT_DDL, gold, ckpt)
    return (gold.read().agg(F.sum("n").cast("long").alias("counted"))
            .select("counted", F.lit(first["rows"]).cast("long").alias("first_rows"),
                    F.lit(second["rows"]).cast("long").alias("second_rows"),
                    F.lit(second["late"]).cast("long").alias("late_rows")))


QUERIES: dict[str, Query] = {
    "operations_log": operations_log,
    "contract_ingestion": contract_ingestion,
    "changes_function": changes_function,
    "feed_refused": feed_refused,
    "feed_gap_rebuild": feed_gap_rebuild,
    "distinct_groups": distinct_groups,
    "stream_drain": stream_drain,
    "stream_dedup": stream_dedup,
    "stream_windows": stream_windows,
    "two_contracts_bronze": two_contracts_bronze,
    "quarantine_counts": quarantine_counts,
    "gold_touched_dates": gold_touched_dates,
    "late_events": late_events,
    "kpi_daily": kpi_daily,
    "bronze_jsonl_roundtrip": bronze_jsonl_roundtrip,
    "bronze_day_overwrite": bronze_day_overwrite,
    "silver_full_merge": silver_full_merge,
    "silver_incremental_merge": silver_incremental_merge,
    "layer_counts": layer_counts,
    "revenue_total": revenue_total,
    "units_total": units_total,
    "ticket_mean": ticket_mean,
    "revenue_by_day": revenue_by_day,
    "revenue_by_category": revenue_by_category,
    "revenue_by_channel": revenue_by_channel,
    "kpi_detail": kpi_detail,
    "control_detail": control_detail,
    "aggregate_detail": aggregate_detail,
    "upsert_orders": upsert_orders,
    "delete_orders": delete_orders,
    "apply_change_batch": apply_change_batch,
    "apply_batch_single_commit": apply_batch_single_commit,
    "change_feed_rows": change_feed_rows,
    "change_type_counts": change_type_counts,
    "affected_groups": affected_groups,
    "recompute_affected": recompute_affected,
    "emptied_groups": emptied_groups,
    "incremental_aggregate": incremental_aggregate,
    "full_aggregate": full_aggregate,
    "delta_aggregate": delta_aggregate,
    "control_counters": control_counters,
    "orders_by_state": orders_by_state,
    "revenue_by_state": revenue_by_state,
    "orders_in_force": orders_in_force,
    "orders_by_city": orders_by_city,
    "recalc_order": recalc_order,
    "transition_violations": transition_violations,
    "amount_violations": amount_violations,
    "batch_conflicts": batch_conflicts,
    "duplicate_keys": duplicate_keys,
    "reemission_count": reemission_count,
    "contract_check": contract_check,
    "cdc_soft_delete": cdc_soft_delete,
    "kpi_filtered": kpi_filtered,
    "cdc_gold": cdc_gold,
    "stream_ingest": stream_ingest,
    "stream_hourly": stream_hourly,
}
