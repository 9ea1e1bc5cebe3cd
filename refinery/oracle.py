"""DuckDB SQL restating every query of :mod:`refinery.queries` on the raw tables.

Money is compared in exact cents on both sides: ``CAST(ROUND(x * 100) AS
BIGINT)`` summed, averages half up by integer division. DuckDB ``SUM`` of an
integer is HUGEINT, so counts and sums are cast back to BIGINT.
"""

from __future__ import annotations

C = "CAST(ROUND({x} * 100) AS BIGINT)"


def _cents(x: str) -> str:
    return C.format(x=x)


def _money(sum_cents: str) -> str:
    return f"CAST({sum_cents} AS DOUBLE) / 100"


def _mean(sum_cents: str, n: str) -> str:
    return f"CAST((2 * ({sum_cents}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


# ---- sales ------------------------------------------------------------------
KPI_SRC = """
  SELECT CAST(l_shipdate AS DATE) AS fecha, l_returnflag AS categoria, l_linestatus AS canal,
         l_quantity AS q, {c} AS c
  FROM {src}"""

KPI_AGG = f"""
  SELECT fecha, categoria, canal, COUNT(*) AS num_ventas, CAST(SUM(q) AS BIGINT) AS unidades,
         {_money('SUM(c)')} AS importe_total, {_mean('SUM(c)', 'COUNT(*)')} AS ticket_medio,
         CAST(SUM(c) AS BIGINT) AS sum_c
  FROM ks GROUP BY fecha, categoria, canal"""

LATEST = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) AS rn
    FROM lineitem) WHERE rn = 1"""


def _kpis(src: str = "lineitem") -> str:
    return (f"ks AS ({KPI_SRC.format(c=_cents('l_extendedprice'), src=src)}),\n"
            f"kpi AS ({KPI_AGG})")


TWO_DAYS = """
  SELECT * EXCLUDE (rn, d) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY d DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) AS rn
    FROM (SELECT *, CASE WHEN l_shipdate < DATE '1998-01-01' THEN 1 ELSE 2 END AS d FROM lineitem
          UNION ALL SELECT * REPLACE (l_extendedprice - 1.0 AS l_extendedprice), 2 FROM lineitem
          WHERE l_orderkey % 11 = 0)) WHERE rn = 1"""


DATES_LATEST = """
  SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_shipdate
  FROM lineitem ORDER BY l_orderkey, l_linenumber, l_shipdate DESC"""

KPI_COLS = "fecha, categoria, canal, num_ventas, unidades, importe_total, ticket_medio"
SALES_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
              "l_discount, l_tax, l_returnflag, l_linestatus")
SALES_TEXT = f"{SALES_COLS}, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"

# ---- orders -----------------------------------------------------------------
ORDERS = """
r AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
             CAST(1 + o_custkey % 6 AS INTEGER) AS o_units, o_totalprice FROM orders),
ins AS (SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey, 'O' AS o_orderstatus)
        FROM r WHERE o_orderkey % 23 = 1),
upd_pre AS (SELECT * FROM r WHERE o_orderkey % 10 = 0 AND o_orderkey % 17 <> 3
            AND o_orderstatus IN ('O', 'P')),
upd AS (SELECT * REPLACE (CASE o_orderstatus WHEN 'O' THEN 'P' ELSE 'F' END AS o_orderstatus)
        FROM upd_pre),
del AS (SELECT * FROM r WHERE o_orderkey % 17 = 3),
final AS (
  SELECT * FROM r WHERE o_orderkey % 17 <> 3
    AND o_orderkey NOT IN (SELECT o_orderkey FROM upd)
  UNION ALL SELECT * FROM upd
  UNION ALL SELECT * FROM ins),
feed AS (
  SELECT *, 'insert' AS _change_type, 1 AS _commit_version FROM ins
  UNION ALL SELECT *, 'update_preimage', 2 FROM upd_pre
  UNION ALL SELECT *, 'update_postimage', 2 FROM upd
  UNION ALL SELECT *, 'delete', 3 FROM del)"""

ORDER_COLS = "o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, o_units, o_totalprice"


def _agg(src: str, group: str = "o_orderstatus") -> str:
    return f"""
  SELECT {group}, COUNT(*) AS num_pedidos, CAST(SUM(o_units) AS BIGINT) AS unidades,
         {_money(f"SUM({_cents('o_totalprice')})")} AS importe_total
  FROM {src} WHERE {group} IS NOT NULL GROUP BY {group}"""


GOLD = f"WITH {ORDERS},\ngold AS ({_agg('final')})\n"

# ---- customers --------------------------------------------------------------
CDC = """
WITH base AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
ch AS (
  SELECT *, 'I' AS op_type, 1 AS _seq FROM base
  UNION ALL SELECT * REPLACE (c_acctbal + 100.0 AS c_acctbal), 'U', 2 FROM base
            WHERE c_custkey % 3 = 1
  UNION ALL SELECT * REPLACE (CASE WHEN c_custkey % 3 = 1 THEN c_acctbal + 100.0
                                   ELSE c_acctbal END AS c_acctbal), 'D', 3 FROM base
            WHERE c_custkey % 5 = 2
  UNION ALL SELECT *, 'I', 4 FROM base WHERE c_custkey % 7 = 2
  UNION ALL SELECT * REPLACE ('renamed ' || c_name AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal), 'D', 6
            FROM base WHERE c_custkey % 29 = 4),
latest AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         CAST(_seq AS BIGINT) AS _seq, op_type = 'D' AS is_deleted,
         CASE WHEN op_type = 'D' THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(_seq AS BIGINT)) END
           AS deleted_at
  FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY _seq DESC) AS rn FROM ch)
  WHERE rn = 1)
"""

HOURLY = f"""
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS n,
       {_money(f"SUM({_cents('value')})")} AS value_sum,
       {_mean(f"SUM({_cents('value')})", 'COUNT(*)')} AS value_avg
FROM events GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    k = _kpis()
    k_silver = _kpis("silver")
    return {
        "kpi_daily": f"WITH {k} SELECT {KPI_COLS} FROM kpi",
        "bronze_jsonl_roundtrip": f"SELECT {SALES_TEXT} FROM lineitem",
        "bronze_day_overwrite": """
            SELECT 'partitioned' AS table_kind, DATE '2024-01-01' AS _ingested_date,
                   COUNT(*) AS n_rows FROM lineitem
            UNION ALL SELECT 'partitioned', DATE '2024-01-02', COUNT(*) FROM lineitem
            UNION ALL SELECT 'append', DATE '2024-01-01', 2 * COUNT(*) FROM lineitem""",
        "silver_full_merge": f"SELECT {SALES_TEXT} FROM ({TWO_DAYS})",
        "silver_incremental_merge": f"SELECT {SALES_TEXT} FROM ({TWO_DAYS})",
        "gold_touched_dates": f"WITH silver AS ({TWO_DAYS}), {k_silver} SELECT {KPI_COLS} FROM kpi",
        "two_contracts_bronze": f"""
            SELECT CASE WHEN l_returnflag = 'R' THEN 'devoluciones' ELSE 'ventas' END AS spec,
                   {SALES_TEXT} FROM lineitem""",
        "quarantine_counts": f"""
            WITH silver AS ({DATES_LATEST}),
            ch AS (SELECT 'kept' AS kind, COUNT(*) AS n FROM (
                     SELECT 1 FROM customer
                     UNION ALL SELECT 1 FROM customer WHERE c_custkey % 3 = 1
                     UNION ALL SELECT 1 FROM customer WHERE c_custkey % 5 = 2
                     UNION ALL SELECT 1 FROM customer WHERE c_custkey % 7 = 2
                     UNION ALL SELECT unnest([5, 6]) FROM customer WHERE c_custkey % 29 = 4)
                   UNION ALL
                   SELECT 'rejected', COUNT(*) FILTER (WHERE c_custkey % 13 = 0)
                     + COUNT(*) FILTER (WHERE c_custkey % 19 = 0)
                     + COUNT(*) FILTER (WHERE c_custkey % 23 = 0) FROM customer)
            SELECT 'ingest' AS step, 'kept' AS kind, COUNT(*) AS n FROM lineitem
            UNION ALL SELECT 'ingest', 'rejected', COUNT(*) FILTER (WHERE l_orderkey % 5 = 0)
                        + COUNT(*) FILTER (WHERE l_orderkey % 23 = 0) FROM lineitem
            UNION ALL SELECT 'gold', 'kept', COUNT(*) FROM silver WHERE l_orderkey % 7 <> 0
                        AND l_shipdate IS NOT NULL
            UNION ALL SELECT 'gold', 'rejected', COUNT(*) FROM silver
                      WHERE l_orderkey % 7 = 0 OR l_shipdate IS NULL
            UNION ALL SELECT 'changes', kind, n FROM ch""",
        "late_events": """
            WITH e AS (SELECT *, date_trunc('hour', ts) AS h FROM events),
            f AS (SELECT DISTINCT h FROM e WHERE event_id % 7 <> 0)
            SELECT COUNT(*) AS counted, COUNT(*) FILTER (WHERE event_id % 7 <> 0) AS first_rows,
                   COUNT(*) FILTER (WHERE event_id % 7 = 0) AS second_rows,
                   COUNT(*) FILTER (WHERE event_id % 7 = 0 AND h IN (SELECT h FROM f)) AS late_rows
            FROM e""",
        "operations_log": f"""
            WITH silver AS ({TWO_DAYS}), {k_silver},
            d AS (SELECT COUNT(*) FILTER (WHERE l_shipdate < DATE '1998-01-01') AS d1,
                         COUNT(*) FILTER (WHERE l_shipdate IS NULL OR l_shipdate >= DATE '1998-01-01')
                         + COUNT(*) FILTER (WHERE l_orderkey % 11 = 0) AS d2 FROM lineitem)
            SELECT 'ingest_bronze' AS step, 'bronze.batch.ventas_raw' AS target, 'ok' AS status,
                   'rejected=0' AS message, CAST(3 AS BIGINT) AS runs, greatest(d1, d2) AS most_rows FROM d
            UNION ALL SELECT 'promote_silver', 'silver.batch.ventas', 'ok', '', 3, COUNT(*) FROM silver
            UNION ALL SELECT 'build_gold', 'gold.batch.ventas_kpis', 'ok',
                   'rejected=' || (SELECT COUNT(*) FROM silver WHERE l_shipdate IS NULL), 1, COUNT(*)
                   FROM kpi WHERE fecha IS NOT NULL""",
        "contract_ingestion": f"""SELECT {SALES_TEXT} FROM (
            SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                       l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
        "changes_function": f"""WITH {ORDERS}
            SELECT 1 AS since, _change_type, COUNT(*) AS n FROM feed GROUP BY _change_type
            UNION ALL SELECT 2, _change_type, COUNT(*) FROM feed WHERE _commit_version >= 2 GROUP BY _change_type""",
        "feed_refused": f"""WITH {ORDERS}
            SELECT "range", true AS refused, CAST(0 AS BIGINT) AS change_rows
            FROM (SELECT unnest(['from version 0', 'beyond the newest', 'empty range']) AS "range")
            UNION ALL SELECT 'whole', false, COUNT(*) FROM feed""",
        "feed_gap_rebuild": GOLD + "SELECT *, 'cold,rebuild,incremental' AS modes FROM gold",
        "distinct_groups": "SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderkey % 29 <> 0",
        "stream_drain": """
            SELECT COUNT(*) AS kept, COUNT(DISTINCT event_id) AS events,
                   COUNT(*) FILTER (WHERE event_id % 11 = 0) AS rejected, 3 AS batches, 0 AS batches_after
            FROM events""",
        "stream_dedup": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "stream_windows": f"""
            WITH e AS (SELECT *, date_trunc('hour', ts) AS h, date_trunc('hour', ts) + INTERVAL 1 HOUR AS h_end,
                              ts < TIMESTAMP '2024-01-16' AND event_id % 7 <> 0 AS one
                       FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL),
            w AS (SELECT date_trunc('milliseconds', MAX(ts) FILTER (WHERE one)) - INTERVAL 10 MINUTE AS w1,
                         date_trunc('milliseconds', MAX(ts)) - INTERVAL 10 MINUTE AS w2 FROM e),
            k AS (SELECT e.*, one OR h_end > w1 AS counted FROM e, w WHERE h_end <= w2)
            SELECT h AS window_start, event_type, COUNT(*) FILTER (WHERE counted) AS n,
                   {_money(f"SUM({_cents('value')}) FILTER (WHERE counted)")} AS value_sum,
                   {_mean(f"SUM({_cents('value')}) FILTER (WHERE counted)", 'COUNT(*) FILTER (WHERE counted)')} AS value_avg,
                   COUNT(*) FILTER (WHERE NOT counted) AS late
            FROM k GROUP BY h, event_type""",
        "layer_counts": f"""
            WITH silver AS ({LATEST}), {k_silver}
            SELECT 'Bronze' AS capa, COUNT(*) AS filas FROM lineitem
            UNION ALL SELECT 'Silver', COUNT(*) FROM silver
            UNION ALL SELECT 'Gold', COUNT(*) FROM kpi""",
        "revenue_total": f"WITH silver AS ({LATEST}), {k_silver} SELECT {_money('SUM(sum_c)')} AS revenue_total FROM kpi",
        "units_total": f"WITH silver AS ({LATEST}), {k_silver} SELECT CAST(SUM(unidades) AS BIGINT) AS units_total FROM kpi",
        "ticket_mean": f"""WITH silver AS ({LATEST}), {k_silver}, t AS (SELECT sum_c, num_ventas,
                               (2 * sum_c + num_ventas) // (2 * num_ventas) AS tc FROM kpi)
            SELECT {_mean('SUM(tc)', 'COUNT(*)')} AS ticket_mean,
                   {_mean('SUM(sum_c)', 'SUM(num_ventas)')} AS ticket_weighted FROM t""",
        "revenue_by_day": f"WITH silver AS ({LATEST}), {k_silver} SELECT fecha, {_money('SUM(sum_c)')} AS importe_total "
                          "FROM kpi GROUP BY fecha",
        "revenue_by_category": f"WITH silver AS ({LATEST}), {k_silver} SELECT categoria, {_money('SUM(sum_c)')} AS "
                               "importe_total FROM kpi GROUP BY categoria",
        "revenue_by_channel": f"WITH silver AS ({LATEST}), {k_silver} SELECT canal, {_money('SUM(sum_c)')} AS importe_total "
                              "FROM kpi GROUP BY canal",
        "kpi_detail": f"WITH silver AS ({LATEST}), {k_silver} SELECT {KPI_COLS} FROM kpi",
        "kpi_filtered": f"""WITH {k} SELECT {KPI_COLS} FROM kpi
            WHERE categoria = 'R' AND canal = 'F' AND ticket_medio IS NOT NULL""",
        "control_detail": f"""WITH {ORDERS}
            SELECT 'silver.cdf.pedidos' AS dataset, CAST(3 AS BIGINT) AS ultima_version,
                   (SELECT COUNT(*) FROM feed) AS filas_procesadas""",
        "control_counters": f"""WITH {ORDERS}
            SELECT CAST(3 AS BIGINT) AS ultima_version,
                   (SELECT COUNT(*) FROM feed) AS filas_procesadas""",
        "aggregate_detail": GOLD + "SELECT * FROM gold",
        "incremental_aggregate": GOLD + "SELECT * FROM gold",
        "full_aggregate": GOLD + "SELECT * FROM gold",
        "delta_aggregate": GOLD + "SELECT * FROM gold",
        "orders_in_force": GOLD + "SELECT CAST(SUM(num_pedidos) AS BIGINT) AS orders_in_force "
                                  "FROM gold",
        "orders_by_state": GOLD + "SELECT o_orderstatus, CAST(SUM(num_pedidos) AS BIGINT) AS "
                                  "num_pedidos FROM gold GROUP BY o_orderstatus",
        "revenue_by_state": GOLD + f"""SELECT o_orderstatus,
            {_money(f"SUM({_cents('importe_total')})")} AS importe_total
            FROM gold GROUP BY o_orderstatus""",
        "orders_by_city": f"WITH {ORDERS} SELECT o_orderpriority, COUNT(*) AS num_pedidos "
                          "FROM final GROUP BY o_orderpriority",
        "upsert_orders": f"""WITH {ORDERS}
            SELECT * FROM r WHERE o_orderkey NOT IN (SELECT o_orderkey FROM upd)
            UNION ALL SELECT * FROM upd UNION ALL SELECT * FROM ins""",
        "delete_orders": f"WITH {ORDERS} SELECT * FROM r WHERE o_orderkey % 17 <> 3",
        "apply_change_batch": f"WITH {ORDERS} SELECT {ORDER_COLS} FROM final",
        "apply_batch_single_commit": f"WITH {ORDERS} SELECT {ORDER_COLS} FROM final",
        "change_feed_rows": f"WITH {ORDERS} SELECT * FROM feed",
        "change_type_counts": f"WITH {ORDERS} SELECT _change_type, COUNT(*) AS n FROM feed "
                              "GROUP BY _change_type",
        "affected_groups": "SELECT unnest(['O', 'P']) AS o_orderstatus",
        "recompute_affected": f"""
            WITH r AS (SELECT o_orderkey, CAST(1 + o_custkey % 6 AS INTEGER) AS o_units, o_totalprice,
                              CASE WHEN o_orderkey % 29 = 0 THEN NULL
                                   WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 0 THEN 'P'
                                   ELSE o_orderstatus END AS o_orderstatus FROM orders),
            g AS ({_agg('r')})
            SELECT * FROM g WHERE o_orderstatus IN ('O', 'P')""",
        "emptied_groups": f"""WITH {ORDERS},
            after AS (SELECT * FROM final WHERE o_orderpriority <> '5-LOW'),
            touched AS (SELECT o_orderpriority FROM feed
                        UNION ALL SELECT o_orderpriority FROM final
                        WHERE o_orderpriority = '5-LOW')
            SELECT DISTINCT o_orderpriority FROM touched
            WHERE o_orderpriority IS NOT NULL
              AND o_orderpriority NOT IN (SELECT o_orderpriority FROM after)""",
        "recalc_order": f"""WITH r AS (SELECT o_orderstatus, o_orderpriority FROM orders)
            SELECT o_orderstatus, COUNT(*) AS num_pedidos,
                   CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-01-01 03:00:00'
                        ELSE TIMESTAMP '2024-01-01 01:00:00' END AS _recalculado_at
            FROM r WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
            GROUP BY o_orderstatus""",
        "transition_violations": """
            WITH u AS (SELECT o_orderkey, o_orderstatus AS from_state,
                              CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F'
                                   WHEN 'F' THEN 'O' ELSE o_orderstatus END AS to_state
                       FROM orders WHERE o_orderkey % 10 = 0),
            allowed(f, t) AS (VALUES ('O', 'P'), ('P', 'F'))
            SELECT * FROM u WHERE NOT EXISTS
              (SELECT 1 FROM allowed WHERE f = from_state AND t = to_state)""",
        "amount_violations": """
            WITH y AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS quantity,
                              90000 + l_partkey AS unit_price_cents FROM lineitem)
            SELECT l_orderkey, l_linenumber, l_partkey, quantity, unit_price_cents,
                   quantity * unit_price_cents + 1 AS amount_cents,
                   quantity * unit_price_cents AS expected_cents, CAST(1 AS BIGINT) AS diff_cents
            FROM y WHERE l_orderkey % 97 = 0""",
        "batch_conflicts": """
            SELECT o_orderkey, 'update_and_delete' AS conflict FROM orders
            WHERE o_orderkey % 10 = 0 AND o_orderkey % 17 = 3
            UNION ALL
            SELECT o_orderkey, 'insert_existing_key' FROM orders WHERE o_orderkey % 41 = 5""",
        "duplicate_keys": """
            SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "reemission_count": """
            SELECT CAST(SUM(copies) AS BIGINT) AS rows, COUNT(*) AS keys,
                   CAST(SUM(copies) - COUNT(*) AS BIGINT) AS reemitted
            FROM (SELECT COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "contract_check": """
            WITH n AS (SELECT COUNT(*) AS rows,
                   COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS k,
                   COUNT(*) FILTER (WHERE o_custkey IS NULL) AS c,
                   COUNT(*) FILTER (WHERE o_orderdate IS NULL AND o_orderkey % 37 <> 0) AS d,
                   COUNT(*) FILTER (WHERE o_orderstatus IS NULL) AS s,
                   COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS p,
                   COUNT(*) FILTER (WHERE o_custkey IS NULL) AS u,
                   COUNT(*) FILTER (WHERE o_totalprice IS NULL AND o_orderkey % 31 <> 0) AS t,
                   COUNT(*) FILTER (WHERE o_orderkey % 37 = 0) AS fd,
                   COUNT(*) FILTER (WHERE o_orderkey % 31 = 0) AS ft FROM orders)
            SELECT "column", expected_type, actual_type, present, nulls,
                   not_null_violations, cast_failures FROM (
              SELECT 'o_orderkey' AS "column", 'bigint' AS expected_type,
                     'bigint' AS actual_type, true AS present, k AS nulls,
                     k AS not_null_violations, CAST(0 AS BIGINT) AS cast_failures FROM n
              UNION ALL SELECT 'o_custkey', 'bigint', 'bigint', true, c, 0, 0 FROM n
              UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', 'string', true, d, 0, fd FROM n
              UNION ALL SELECT 'o_orderstatus', 'string', 'string', true, s, 0, 0 FROM n
              UNION ALL SELECT 'o_orderpriority', 'string', 'string', true, p, 0, 0 FROM n
              UNION ALL SELECT 'o_units', 'int', 'int', true, u, 0, 0 FROM n
              UNION ALL SELECT 'o_totalprice', 'double', 'string', true, t, 0, ft FROM n
              UNION ALL SELECT '_updated_at', 'timestamp', NULL, false, rows, 0, 0 FROM n)""",
        "cdc_soft_delete": CDC + "SELECT * FROM latest",
        "cdc_gold": CDC + f"""
            SELECT c_mktsegment,
                   COUNT(*) FILTER (WHERE NOT is_deleted) AS active_customers,
                   COUNT(*) FILTER (WHERE is_deleted) AS deleted_customers,
                   {_money(f"COALESCE(SUM({_cents('c_acctbal')}) FILTER (WHERE NOT is_deleted), 0)")}
                     AS active_balance
            FROM latest GROUP BY c_mktsegment""",
        "stream_ingest": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "stream_hourly": HOURLY,
    }
