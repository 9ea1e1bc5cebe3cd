"""Roles of the driver's test tables in the three pipelines.

* sales (batch pipeline): ``lineitem``. Key ``(l_orderkey, l_linenumber)`` is
  not unique, so the table is a natural set of re-emitted sales. Date
  ``l_shipdate``, category ``l_returnflag``, channel ``l_linestatus``,
  quantity ``l_quantity``, amount ``l_extendedprice``.
* orders (change-feed pipeline): ``orders``. Group ``o_orderstatus``, city
  ``o_orderpriority``, amount ``o_totalprice``, units ``1 + o_custkey % 6``.
* customers (CDC pipeline): ``customer`` with an operation derived from the key.
* stream: ``events``.

The change batch applied to the orders table is derived from the data by
arithmetic on the key, so plain SQL can restate it (see ``oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.contracts import Contract


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- sales -------------------------------------------------------------
SALES_KEYS = ["l_orderkey", "l_linenumber"]
SALES_ROLE = dict(date="l_shipdate", category="l_returnflag", channel="l_linestatus",
                  quantity="l_quantity", amount="l_extendedprice")
# the version ingested last wins; within one ingestion the latest ship date, then all columns
SALES_ORDER = ("_ingested_at", "l_shipdate")

_LANDING_COLS = [
    ("l_orderkey", "LONG", False), ("l_partkey", "LONG", True), ("l_suppkey", "LONG", True),
    ("l_linenumber", "INTEGER", False), ("l_quantity", "DOUBLE", True),
    ("l_extendedprice", "DOUBLE", True), ("l_discount", "DOUBLE", True),
    ("l_tax", "DOUBLE", True), ("l_returnflag", "STRING", True),
    ("l_linestatus", "STRING", True), ("l_shipdate", "STRING", True),
]
_META_COLS = [("_ingested_at", "TIMESTAMP", True), ("_ingested_date", "DATE", True),
              ("_source_file", "STRING", True)]


def _cols(spec):
    return [{"name": n, "type": t, "nullable": nl} for n, t, nl in spec]


# Contracts. The Silver/Gold/control table and column names that a consumer
# queries (ventas, ventas_kpis, pedidos_agregado, cdf_control and their
# Spanish column names) are fixed values of the original table contracts; the
# data columns come from the driver's test tables.
LANDING_SALES = Contract.from_dict({
    "name": "ventas_landing", "schema": "batch", "catalog": "landing", "format": "json",
    "columns": _cols(_LANDING_COLS)})
BRONZE_SALES = Contract.from_dict({
    "name": "ventas_raw", "schema": "batch", "catalog": "bronze",
    "columns": _cols(_LANDING_COLS + _META_COLS), "partitions": ["_ingested_date"]})
SILVER_SALES = Contract.from_dict({
    "name": "ventas", "schema": "batch", "catalog": "silver", "keys": SALES_KEYS,
    "columns": _cols(_LANDING_COLS + _META_COLS + [("_silver_modified_at", "TIMESTAMP", True)])})
GOLD_KPIS = Contract.from_dict({
    "name": "ventas_kpis", "schema": "batch", "catalog": "gold",
    "keys": ["fecha", "categoria", "canal"],
    "columns": _cols([("fecha", "DATE", False), ("categoria", "STRING", False),
                      ("canal", "STRING", False), ("num_ventas", "LONG", True),
                      ("unidades", "LONG", True), ("importe_total", "DOUBLE", True),
                      ("ticket_medio", "DOUBLE", True), ("_generated_at", "TIMESTAMP", True)])})


def sales_landing(lineitem: DataFrame) -> DataFrame:
    """Landing rows of the sales role: dates as text, as a JSON producer writes them."""
    return lineitem.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


# ---- orders ------------------------------------------------------------
ORDER_KEYS = ["o_orderkey"]
ORDER_GROUP = "o_orderstatus"
ORDER_UNITS = "o_units"
ORDER_AMOUNT = "o_totalprice"
ORDER_CITY = "o_orderpriority"

# The lifecycle of the test table's order states, and the
# parameters of the derived change batch.
ORDER_TRANSITIONS = {"O": ["P"], "P": ["F"], "F": []}
DELETE_MOD, DELETE_REM = 17, 3
UPDATE_MOD, UPDATE_REM = 10, 0
INSERT_MOD, INSERT_REM = 23, 1
# new keys are negative (-1 - key), so they cannot exist at any scale

SILVER_ORDERS = Contract.from_dict({
    "name": "pedidos", "schema": "cdf", "catalog": "silver", "keys": ORDER_KEYS,
    "change_data_feed": True, "partitions": [ORDER_GROUP],
    "columns": _cols([("o_orderkey", "LONG", False), ("o_custkey", "LONG", True),
                      ("o_orderdate", "TIMESTAMP_NTZ", True), ("o_orderstatus", "STRING", True),
                      ("o_orderpriority", "STRING", True), ("o_units", "INTEGER", True),
                      ("o_totalprice", "DOUBLE", True), ("_updated_at", "TIMESTAMP", True)])})
GOLD_ORDERS = Contract.from_dict({
    "name": "pedidos_agregado", "schema": "cdf", "catalog": "gold", "keys": [ORDER_GROUP],
    "columns": _cols([(ORDER_GROUP, "STRING", False), ("num_pedidos", "LONG", True),
                      ("unidades", "LONG", True), ("importe_total", "DOUBLE", True),
                      ("_recalculado_at", "TIMESTAMP", True)])})
CONTROL = Contract.from_dict({
    "name": "cdf_control", "schema": "cdf", "catalog": "gold", "keys": ["dataset"],
    "columns": _cols([("dataset", "STRING", False), ("ultima_version", "LONG", True),
                      ("filas_procesadas", "LONG", True), ("_actualizado_at", "TIMESTAMP", True)])})


def orders_rows(orders: DataFrame) -> DataFrame:
    """The orders table in the change-feed role (no stamp)."""
    return orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                         "o_orderpriority",
                         (F.lit(1) + F.col("o_custkey") % 6).cast("int").alias(ORDER_UNITS),
                         "o_totalprice")


def _advance(col: str):
    """Proposed new state: O->P, P->F and, planted for the lifecycle check, F->O."""
    return (F.when(F.col(col) == "O", "P").when(F.col(col) == "P", "F")
            .when(F.col(col) == "F", "O").otherwise(F.col(col)))


def proposed_batch(rows: DataFrame) -> dict[str, DataFrame]:
    """The raw change batch, before the quality gate (Q1, Q3)."""
    k = F.col("o_orderkey")
    inserts = (rows.where(k % INSERT_MOD == INSERT_REM)
               .withColumn("o_orderkey", -k - 1)
               .withColumn(ORDER_GROUP, F.lit("O")))
    updates = rows.where(k % UPDATE_MOD == UPDATE_REM).withColumn(ORDER_GROUP, _advance(ORDER_GROUP))
    deletes = rows.where(k % DELETE_MOD == DELETE_REM).select(*ORDER_KEYS)
    return {"inserts": inserts, "updates": updates, "deletes": deletes}


def valid_batch(rows: DataFrame) -> dict[str, DataFrame]:
    """The batch that is applied: updates of deleted keys and illegal moves dropped."""
    from refinery.operators.quality import transition_violations
    b = proposed_batch(rows)
    bad = transition_violations(b["updates"], rows, ORDER_KEYS, ORDER_GROUP, ORDER_TRANSITIONS)
    updates = (b["updates"].join(b["deletes"], ORDER_KEYS, "left_anti")
               .join(bad.select(*ORDER_KEYS), ORDER_KEYS, "left_anti"))
    return {"inserts": b["inserts"], "updates": updates, "deletes": b["deletes"]}


# ---- customers (CDC) ---------------------------------------------------
CUSTOMER_KEYS = ["c_custkey"]
# The derived CDC stream. Every customer is inserted (seq 1);
# key % 3 == 1 is updated (seq 2, balance + 100); key % 5 == 2 is deleted
# (seq 3); key % 7 == 2 is inserted again (seq 4), which revives a deleted row.
CDC_UPDATE = (3, 1)
CDC_DELETE = (5, 2)
CDC_REVIVE = (7, 2)
CDC_BALANCE_STEP = 100.0
CDC_EPOCH = 1_704_067_200         # 2024-01-01 00:00:00 UTC

SILVER_CUSTOMERS = Contract.from_dict({
    "name": "clientes", "schema": "cdc", "catalog": "silver", "keys": CUSTOMER_KEYS,
    "columns": _cols([("c_custkey", "LONG", False), ("c_name", "STRING", True),
                      ("c_nationkey", "INTEGER", True), ("c_acctbal", "DOUBLE", True),
                      ("c_mktsegment", "STRING", True), ("_seq", "LONG", True),
                      ("is_deleted", "BOOLEAN", True), ("deleted_at", "TIMESTAMP", True),
                      ("_column_seq", "MAP<STRING,LONG>", True)])})
GOLD_CUSTOMERS = Contract.from_dict({
    "name": "clientes_segmento", "schema": "cdc", "catalog": "gold", "keys": ["c_mktsegment"],
    "columns": _cols([("c_mktsegment", "STRING", True), ("active_customers", "LONG", True),
                      ("deleted_customers", "LONG", True), ("active_balance", "DOUBLE", True)])})


def customer_changes(customer: DataFrame) -> DataFrame:
    """S9 rows: the customer table as an I/U/D change stream with a sequence."""
    k = F.col("c_custkey")
    base = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ins = base.withColumn("op_type", F.lit("I")).withColumn("_seq", F.lit(1).cast("long"))
    upd = (base.where(k % CDC_UPDATE[0] == CDC_UPDATE[1])
           .withColumn("c_acctbal", F.col("c_acctbal") + CDC_BALANCE_STEP)
           .withColumn("op_type", F.lit("U")).withColumn("_seq", F.lit(2).cast("long")))
    # the delete record carries the row image at delete time (after its update)
    dele = (base.where(k % CDC_DELETE[0] == CDC_DELETE[1])
            .withColumn("c_acctbal", F.when(k % CDC_UPDATE[0] == CDC_UPDATE[1],
                                            F.col("c_acctbal") + CDC_BALANCE_STEP)
                        .otherwise(F.col("c_acctbal")))
            .withColumn("op_type", F.lit("D")).withColumn("_seq", F.lit(3).cast("long")))
    rev = (base.where(k % CDC_REVIVE[0] == CDC_REVIVE[1])
           .withColumn("op_type", F.lit("I")).withColumn("_seq", F.lit(4).cast("long")))
    every = ins.unionByName(upd).unionByName(dele).unionByName(rev)
    # the operation's time: one hour per sequence number
    return every.withColumn("op_time", F.timestamp_seconds(F.lit(CDC_EPOCH) + F.col("_seq") * 3600))


def key_only_deletes(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deletes that carry nothing but their key (sequence 6), and the older updates of the
    same customers (sequence 5: a new name, no balance), for customers whose key % 29 is 4."""
    base = customer_changes(customer).where("_seq = 1").where(F.col("c_custkey") % 29 == 4)
    at = F.timestamp_seconds(F.lit(CDC_EPOCH) + F.col("_seq") * 3600)
    bare = base.select("c_custkey", *[F.lit(None).cast(base.schema[c].dataType).alias(c)
                                      for c in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")],
                       F.lit("D").alias("op_type"), F.lit(6).cast("long").alias("_seq")).withColumn("op_time", at)
    older = (base.withColumn("_seq", F.lit(5).cast("long")).withColumn("op_type", F.lit("U"))
             .withColumn("c_name", F.concat(F.lit("renamed "), "c_name"))
             .withColumn("c_acctbal", F.lit(None).cast("double")).withColumn("op_time", at))
    return bare, older


def planted_changes(customer: DataFrame) -> DataFrame:
    """Change records that must be refused: an unknown operation, none, and a null key,
    all with a sequence that would win if they were applied."""
    k = F.col("c_custkey")
    base = customer_changes(customer).where("_seq = 1").withColumn("_seq", F.lit(9).cast("long"))
    return (base.where(k % 13 == 0).withColumn("op_type", F.lit("X"))
            .unionByName(base.where(k % 19 == 0).withColumn("op_type", F.lit(None).cast("string")))
            .unionByName(base.where(k % 23 == 0).withColumn("op_type", F.lit("D"))
                         .withColumn("c_custkey", F.lit(None).cast("long"))))
