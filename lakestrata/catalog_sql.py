"""DuckDB oracle SQL for the registered queries (same column names as Spark).

The driver registers the parquet tables as views; the adapters below repeat
the Spark adapters in SQL so each query is checked end to end."""

from __future__ import annotations

SO = """so AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'cancelled' END AS order_status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS net_amount
  FROM orders)"""

SC = """sc AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS market FROM customer)"""

CAL = """cal AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS calendar_date
  FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM so) b WHERE lo IS NOT NULL)"""

# completed orders are summed per key first; a repeated dimension row multiplies the sum
CV = """cv AS (
  SELECT buyer.customer_id, buyer.market, bought.first_order_date, bought.latest_order_date,
         bought.paid * buyer.copies AS lifetime_net_revenue, COALESCE(bought.orders, 0) AS completed_orders
  FROM (SELECT customer_id, market, COUNT(*) AS copies FROM sc GROUP BY customer_id, market) buyer
  LEFT JOIN (
    SELECT customer_id, MIN(order_date) AS first_order_date, MAX(order_date) AS latest_order_date,
           SUM(net_amount) AS paid, COUNT(DISTINCT order_id) AS orders
    FROM so WHERE order_status = 'completed' GROUP BY customer_id) bought
  ON bought.customer_id = buyer.customer_id)"""

DR = """dr AS (
  SELECT calendar_date, COALESCE(orders, 0) AS order_count, COALESCE(paid, 0) AS gross_revenue
  FROM cal LEFT JOIN (
    SELECT order_date, COUNT(DISTINCT order_id) AS orders, SUM(net_amount) AS paid
    FROM so WHERE order_status = 'completed' GROUP BY order_date) sold
  ON order_date = calendar_date)"""

SQL: dict[str, str] = {}

SQL["gold_customer_value"] = f"""
WITH {SO}, {SC}, {CV}
SELECT customer_id, market, first_order_date, latest_order_date,
       CAST(lifetime_net_revenue AS DOUBLE) AS lifetime_net_revenue, completed_orders
FROM cv"""

SQL["gold_daily_revenue"] = f"""
WITH {SO}, {CAL}, {DR}
SELECT calendar_date, order_count, CAST(gross_revenue AS DOUBLE) AS gross_revenue FROM dr"""

SQL["gold_commercial_summary"] = f"""
WITH {SO}, {SC}, {CAL}, {CV}, {DR}
SELECT market, COUNT(DISTINCT customer_id) AS customers, CAST(SUM(lifetime_net_revenue) AS DOUBLE) AS lifetime_net_revenue,
       (SELECT CAST(SUM(gross_revenue) AS DOUBLE) FROM dr WHERE calendar_date >= DATE '2001-07-02') AS revenue_last_30_days
FROM cv GROUP BY market"""

EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS source_event_id, ts AS source_updated_at, 'RUN-0187' AS ingestion_run_id,
         CAST(floor(event_id / 250) AS INTEGER) + 1 AS source_page, props AS payload FROM events)"""

BRONZE_EV = f"""{EV},
ev_max AS (SELECT MAX(source_page) AS m FROM ev),
bronze AS (
  SELECT ev.*, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, CAST(source_page - 1 AS BIGINT) AS commit_version FROM ev
  UNION ALL
  SELECT ev.*, TIMESTAMP '2024-02-01 01:00:00' AS ingested_at,
         CAST(ev_max.m + CASE source_page WHEN 3 THEN 0 WHEN 7 THEN 1 END AS BIGINT) AS commit_version
  FROM ev, ev_max WHERE source_page IN (3, 7))"""

W1_ORDER = """ORDER BY source_updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST,
  ingestion_run_id DESC NULLS LAST, source_page DESC NULLS LAST, payload ASC NULLS LAST"""

SQL["silver_dedupe_events"] = f"""
WITH {BRONZE_EV}
SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY source_event_id {W1_ORDER}) = 1"""

SQL["payload_json_field"] = f"""
WITH {BRONZE_EV}
SELECT source_event_id, source_page, commit_version, json_extract_string(payload, '$.k') AS k FROM bronze"""


def _orders_bronze(defects: bool) -> str:
    date_text = "strftime(o_orderdate, '%Y-%m-%d')"
    amount_text = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
    if defects:
        date_text = f"CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%-m-%-d') ELSE {date_text} END"
        amount_text = (
            f"CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' "
            f"THEN {amount_text} || '5' ELSE {amount_text} END"
        )
    return f"""od AS (
  SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS source_event_id,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 12 HOUR AS source_updated_at,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, 'RUN-0187' AS ingestion_run_id,
         CAST(floor(o_orderkey / 1000) AS INTEGER) + 1 AS source_page,
         CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         {date_text} AS date_text,
         CASE o_orderpriority WHEN '1-URGENT' THEN upper(st) WHEN '2-HIGH' THEN upper(substr(st, 1, 1)) || substr(st, 2)
              ELSE st END AS status_text,
         {amount_text} AS amount_text, o_orderstatus
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'cancelled' END AS st
        FROM orders) o),
ob AS (
  SELECT source_event_id, source_updated_at, ingested_at, ingestion_run_id, source_page, order_id, customer_id,
         date_text, status_text, amount_text FROM od
  UNION ALL
  SELECT source_event_id, source_updated_at + INTERVAL 1 DAY, ingested_at + INTERVAL 1 DAY, ingestion_run_id,
         source_page, order_id, customer_id, date_text, 'completed', amount_text FROM od WHERE o_orderstatus = 'O'),
okeep AS (
  SELECT * FROM ob QUALIFY row_number() OVER (PARTITION BY source_event_id ORDER BY source_updated_at DESC,
    ingested_at DESC, ingestion_run_id DESC, source_page DESC) = 1)"""


SQL["silver_orders"] = f"""
WITH {_orders_bronze(False)}
SELECT order_id, customer_id, CAST(date_text AS DATE) AS order_date, lower(status_text) AS order_status,
       CAST(CAST(amount_text AS DECIMAL(18,2)) AS DOUBLE) AS net_amount, source_updated_at, ingestion_run_id
FROM okeep"""

SQL["silver_rejects"] = f"""
WITH {_orders_bronze(True)},
r AS (
  SELECT source_event_id, source_page,
         CASE WHEN NOT COALESCE(regexp_full_match(date_text, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
                                AND TRY_CAST(date_text AS DATE) IS NOT NULL, false) THEN 'bad_order_date'
              WHEN NOT COALESCE(TRY_CAST(amount_text AS DECIMAL(18,2)) = TRY_CAST(amount_text AS DECIMAL(38,18)), false)
                   THEN 'bad_net_amount' END AS reject_reason
  FROM okeep)
SELECT * FROM r WHERE reject_reason IS NOT NULL"""

SQL["silver_customers"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS market,
       TIMESTAMP '2024-01-15 00:00:00' AS source_updated_at, 'RUN-0187' AS ingestion_run_id
FROM customer"""

EVC = """evc AS (SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS market, ts AS source_updated_at,
                      CAST(event_id AS VARCHAR) AS source_event_id FROM events)"""

CV_OVER = """SELECT c.customer_id, c.market,
       MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS latest_order_date,
       CAST(SUM(o.net_amount) AS DOUBLE) AS lifetime_net_revenue, COUNT(DISTINCT o.order_id) AS completed_orders
FROM {c} AS c LEFT JOIN so AS o ON c.customer_id = o.customer_id AND o.order_status = 'completed'
GROUP BY c.customer_id, c.market"""

SQL["customer_value_fanout"] = f"""
WITH {SO}, {EVC}
{CV_OVER.format(c="evc")}"""

SQL["customer_value_grain_enforced"] = f"""
WITH {SO}, {EVC},
latest AS (SELECT * FROM evc QUALIFY row_number() OVER (PARTITION BY customer_id
           ORDER BY source_updated_at DESC NULLS LAST, source_event_id DESC NULLS LAST) = 1)
{CV_OVER.format(c="latest")}"""

LANDING = """land AS (
  SELECT CAST(floor(event_id / 250) AS INTEGER) + 1 AS source_page, event_id, ts,
         CASE WHEN event_type = 'error' AND value < 1.0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS rec_event_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS rec_updated_at,
         CAST(user_id AS VARCHAR) AS rec_user_id, event_type, CAST(value AS VARCHAR) AS rec_value
  FROM events)"""

VALIDATION = """val AS (
  SELECT source_page, COUNT(*) AS records,
         COUNT(*) FILTER (WHERE COALESCE(rec_event_id, '') = '') AS missing_event_id,
         COUNT(*) FILTER (WHERE COALESCE(rec_updated_at, '') = '') AS missing_updated_at,
         CAST(0 AS BIGINT) AS bad_updated_at
  FROM land GROUP BY source_page)"""

SQL["bronze_envelope"] = f"""
WITH {LANDING}
SELECT rec_event_id AS source_event_id, ts AS source_updated_at, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
       'RUN-0187' AS ingestion_run_id, source_page,
       '{{"event_id":"' || rec_event_id || '","updated_at":"' || rec_updated_at || '","user_id":"' || rec_user_id
       || '","event_type":"' || event_type || '","value":"' || rec_value || '"}}' AS payload
FROM land"""

SQL["page_validation"] = f"""
WITH {LANDING}, {VALIDATION}
SELECT *, (missing_event_id = 0 AND missing_updated_at = 0 AND bad_updated_at = 0) AS is_valid FROM val"""

SQL["committable_pages"] = f"""
WITH {LANDING}, {VALIDATION},
v AS (SELECT source_page, (missing_event_id = 0 AND missing_updated_at = 0 AND bad_updated_at = 0) AS is_valid FROM val),
first_bad AS (SELECT MIN(source_page) AS p FROM v WHERE NOT is_valid)
SELECT source_page, is_valid, COALESCE(source_page < (SELECT p FROM first_bad), true) AS committable FROM v"""

SQL["pending_pages"] = f"""
WITH {LANDING},
pages AS (SELECT DISTINCT source_page FROM land),
done AS (SELECT source_page FROM land GROUP BY source_page HAVING MAX(ts) < TIMESTAMP '2024-01-16 00:00:00')
SELECT source_page, 'RUN-A' AS run_id FROM pages WHERE source_page NOT IN (SELECT source_page FROM done)
UNION ALL
SELECT source_page, 'RUN-B' AS run_id FROM pages"""

SQL["commit_history"] = f"""
WITH {BRONZE_EV},
h AS (SELECT commit_version, ingestion_run_id, source_page, COUNT(*) AS rows, MIN(ingested_at) AS ingested_at
      FROM bronze GROUP BY ALL)
SELECT *, COUNT(*) OVER (PARTITION BY ingestion_run_id, source_page) AS commits_for_page FROM h"""

SQL["bronze_replay_report"] = f"""
WITH {BRONZE_EV}
SELECT source_page, COUNT(*) AS rows, COUNT(DISTINCT source_event_id) AS distinct_events,
       COUNT(DISTINCT commit_version) AS commits, COUNT(*) - COUNT(DISTINCT source_event_id) AS duplicate_rows
FROM bronze GROUP BY source_page"""

SQL["replayed_events"] = f"""
WITH {BRONZE_EV}
SELECT source_event_id, COUNT(*) AS deliveries,
       COUNT(DISTINCT commit_version) AS commits, MIN(commit_version) AS first_commit, MAX(commit_version) AS last_commit,
       COUNT(DISTINCT source_page) AS pages, MIN(source_page) AS first_page, MAX(source_page) AS last_page
FROM bronze GROUP BY source_event_id HAVING COUNT(*) > 1"""

SQL["ingest_summary"] = f"""
WITH {BRONZE_EV},
pg AS (SELECT DISTINCT ingestion_run_id, source_page FROM bronze),
isl AS (SELECT ingestion_run_id, source_page,
               source_page - row_number() OVER (PARTITION BY ingestion_run_id ORDER BY source_page) AS island FROM pg),
rng AS (SELECT ingestion_run_id, MIN(source_page) AS lo, MAX(source_page) AS hi, COUNT(*) AS n FROM isl GROUP BY ALL),
txt AS (SELECT ingestion_run_id,
               string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE CAST(lo AS VARCHAR) || '-' || CAST(hi AS VARCHAR) END,
                          ',' ORDER BY lo) AS pages_appended,
               CAST(SUM(n) AS BIGINT) AS page_count
        FROM rng GROUP BY ingestion_run_id),
per_run AS (SELECT ingestion_run_id, MIN(commit_version) AS first_version, MAX(commit_version) AS last_version,
                   COUNT(DISTINCT commit_version) AS commits, COUNT(*) AS rows_appended FROM bronze GROUP BY ALL)
SELECT per_run.*, txt.pages_appended, txt.page_count FROM per_run JOIN txt USING (ingestion_run_id)"""

# Observed driver-table columns for the feed contracts (name, DuckDB type).
FEED_TABLE_COLUMNS = {
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}


def _feed_expected() -> str:
    from .contracts import FEED_CONTRACTS

    rows = ",\n  ".join(
        f"('{c.name}', '{col.name}', '{col.dtype.simpleString()}', {str(col.nullable).lower()})"
        for c in FEED_CONTRACTS
        for col in c.columns
    )
    return f"expected(table_name, column_name, data_type, nullable) AS (VALUES\n  {rows})"


def _feed_nulls() -> str:
    parts = [
        f"SELECT 'feed.{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n FROM {t}"
        for t, cols in FEED_TABLE_COLUMNS.items()
        for c in cols
    ]
    return "obs_nulls AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


_TABLES_IN = ", ".join(f"'{t}'" for t in FEED_TABLE_COLUMNS)

SQL["contract_classification"] = f"""
WITH {_feed_expected()},
obs_meta AS (
  SELECT 'feed.' || table_name AS table_name, column_name,
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
              WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
              ELSE lower(data_type) END AS data_type
  FROM information_schema.columns WHERE table_name IN ({_TABLES_IN})),
{_feed_nulls()},
observed AS (SELECT m.table_name, m.column_name, m.data_type, n.n > 0 AS nullable
             FROM obs_meta m JOIN obs_nulls n ON m.table_name = n.table_name AND m.column_name = n.column_name),
j AS (
  SELECT COALESCE(e.table_name, o.table_name) AS table_name, COALESCE(e.column_name, o.column_name) AS column_name,
         e.data_type AS e_type, e.nullable AS e_null, o.data_type AS o_type, o.nullable AS o_null
  FROM expected e FULL OUTER JOIN observed o ON e.table_name = o.table_name AND e.column_name = o.column_name
  WHERE COALESCE(e.table_name, o.table_name) IN (SELECT table_name FROM expected)),
per AS (
  SELECT table_name,
    COALESCE(array_to_string(list_sort(list(column_name) FILTER (WHERE e_type IS NULL)), ','), '') AS added,
    COALESCE(array_to_string(list_sort(list(column_name) FILTER (WHERE o_type IS NULL)), ','), '') AS removed,
    COALESCE(array_to_string(list_sort(list(column_name || ':' || e_type || '>' || o_type)
             FILTER (WHERE e_type IS NOT NULL AND o_type IS NOT NULL AND e_type <> o_type)), ','), '') AS retyped,
    COALESCE(array_to_string(list_sort(list(column_name)
             FILTER (WHERE o_type IS NOT NULL AND NOT e_null AND o_null)), ','), '') AS loosened
  FROM j GROUP BY table_name)
SELECT table_name,
       CASE WHEN removed <> '' OR retyped <> '' OR loosened <> '' THEN 'breaking'
            WHEN added <> '' THEN 'additive' ELSE 'none' END AS kind,
       added, removed, retyped, loosened
FROM per"""

SQL["null_audit"] = f"""
WITH {BRONZE_EV},
b AS (SELECT bronze.* REPLACE (CASE WHEN e.event_type = 'error' THEN NULL ELSE bronze.payload END AS payload)
      FROM bronze JOIN events e ON bronze.source_event_id = CAST(e.event_id AS VARCHAR))
SELECT 'orders_raw' AS table_name, column_name, null_count, (SELECT COUNT(*) FROM b) AS rows FROM (
  SELECT 'source_event_id' AS column_name, COUNT(*) - COUNT(source_event_id) AS null_count FROM b
  UNION ALL SELECT 'source_updated_at', COUNT(*) - COUNT(source_updated_at) FROM b
  UNION ALL SELECT 'ingestion_run_id', COUNT(*) - COUNT(ingestion_run_id) FROM b
  UNION ALL SELECT 'source_page', COUNT(*) - COUNT(source_page) FROM b
  UNION ALL SELECT 'ingested_at', COUNT(*) - COUNT(ingested_at) FROM b
  UNION ALL SELECT 'commit_version', COUNT(*) - COUNT(commit_version) FROM b
  UNION ALL SELECT 'payload', COUNT(*) - COUNT(payload) FROM b)"""

SQL["grain_violations"] = """
SELECT CAST(user_id AS VARCHAR) AS customer_id, COUNT(*) AS rows FROM events GROUP BY 1 HAVING COUNT(*) > 1"""

SQL["constraint_violations"] = """
WITH eo AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(ts AS DATE) AS order_date,
         CAST(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) * -3 ELSE CAST(value AS DECIMAL(18,2)) END
              AS DECIMAL(18,2)) AS net_amount
  FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS calendar_date
        FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM eo) b WHERE lo IS NOT NULL),
dr AS (SELECT d.calendar_date, COUNT(DISTINCT o.order_id) AS order_count, COALESCE(SUM(o.net_amount), 0) AS gross_revenue
       FROM cal d LEFT JOIN eo o ON o.order_date = d.calendar_date GROUP BY d.calendar_date)
SELECT calendar_date, order_count, CAST(gross_revenue AS DOUBLE) AS gross_revenue FROM dr WHERE NOT (gross_revenue >= 0)"""

SQL["customer_value_incremental"] = SQL["gold_customer_value"]

SQL["refresh_decision"] = """
WITH ticks AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS tick
  FROM (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events) b WHERE lo IS NOT NULL),
order_days AS (SELECT DISTINCT CAST(MAX(ts) AS DATE) AS tick FROM events GROUP BY CAST(floor(event_id / 250) AS INTEGER)),
cust_days AS (SELECT DISTINCT CAST(MIN(ts) AS DATE) AS tick FROM events GROUP BY user_id),
flags AS (
  SELECT t.tick, 'silver.orders' AS table_name, CASE WHEN d.tick IS NULL THEN 0 ELSE 1 END AS c
  FROM ticks t LEFT JOIN order_days d ON t.tick = d.tick
  UNION ALL
  SELECT t.tick, 'silver.customers', CASE WHEN d.tick IS NULL THEN 0 ELSE 1 END
  FROM ticks t LEFT JOIN cust_days d ON t.tick = d.tick),
log AS (
  SELECT tick, table_name, CAST(COALESCE(SUM(c) OVER (PARTITION BY table_name ORDER BY tick
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS version FROM flags
  UNION ALL SELECT tick, 'silver.calendar', CAST(0 AS BIGINT) FROM ticks),
graph(view, table_name) AS (VALUES ('gold.customer_value', 'silver.orders'), ('gold.customer_value', 'silver.customers'),
  ('gold.daily_revenue', 'silver.calendar'), ('gold.daily_revenue', 'silver.orders'),
  ('gold.commercial_summary', 'gold.customer_value'), ('gold.commercial_summary', 'gold.daily_revenue')),
moved AS (
  SELECT g.view, l.tick,
         LAG(l.version) OVER (PARTITION BY g.view, g.table_name ORDER BY l.tick) AS prev, l.version
  FROM graph g JOIN log l ON g.table_name = l.table_name),
level1 AS (
  SELECT tick, view, CASE WHEN MAX(CASE WHEN prev IS NULL OR version > prev THEN 1 ELSE 0 END) = 1
                          THEN 'refresh' ELSE 'skip' END AS decision
  FROM moved GROUP BY tick, view),
level2 AS (
  SELECT l.tick, g.view, CASE WHEN MAX(CASE WHEN l.decision = 'refresh' THEN 1 ELSE 0 END) = 1
                              THEN 'refresh' ELSE 'skip' END AS decision
  FROM graph g JOIN level1 l ON g.table_name = l.view GROUP BY l.tick, g.view)
SELECT * FROM level1 UNION ALL SELECT * FROM level2"""

SQL["schema_merge_append"] = f"""
WITH {BRONZE_EV}
SELECT commit_version, COUNT(*) AS rows,
       COUNT(CASE WHEN ingested_at > TIMESTAMP '2024-02-01 00:00:00' THEN json_extract_string(payload, '$.k') END) AS region_rows,
       MAX(CASE WHEN ingested_at > TIMESTAMP '2024-02-01 00:00:00' THEN json_extract_string(payload, '$.k') END) AS max_region
FROM bronze GROUP BY commit_version"""

SQL["streaming_bronze_counts"] = """
SELECT source_page, COUNT(*) * commits AS rows, COUNT(*) AS events, commits, MIN(ts) AS first_update
FROM (SELECT CAST(floor(event_id / 250) AS INTEGER) + 1 AS source_page, ts,
             CASE WHEN floor(event_id / 250) = (SELECT floor(MAX(event_id) / 250) FROM events) THEN 2 ELSE 1 END AS commits
      FROM events)
GROUP BY source_page, commits"""

MANIFESTS = """page_done AS (SELECT CAST(MAX(ts) AS DATE) AS day FROM events GROUP BY CAST(floor(event_id / 250) AS INTEGER)),
completions AS (SELECT day, COUNT(*) AS pages FROM page_done GROUP BY day),
days AS (SELECT CAST(ts AS DATE) AS day, arg_min(event_type, ts) AS first_type, COUNT(*) AS rows_appended
         FROM events GROUP BY 1),
m0 AS (
  SELECT d.day, d.rows_appended, c.pages,
         CASE WHEN first_type IN ('purchase', 'click') THEN 'ok'
              WHEN first_type = 'view' THEN 'validation_error: record missing event_id'
              WHEN first_type = 'signup' THEN 'checkpoint_write_interrupted: simulated crash after commit'
              ELSE 'error: unparsable updated_at' END AS status
  FROM days d LEFT JOIN completions c ON d.day = c.day),
m1 AS (SELECT *, CAST(CASE WHEN status LIKE 'error:%' OR status LIKE 'validation_error:%' THEN 0
                           ELSE COALESCE(pages, 0) END AS BIGINT) AS commits FROM m0),
manifests AS (
  SELECT 'RUN-' || strftime(day, '%Y%m%d') AS run_id, CAST(day AS TIMESTAMP) AS finished_at, status, rows_appended,
         CAST(COALESCE(SUM(commits) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
           AS version_before,
         CAST(COALESCE(SUM(commits) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + commits
              AS BIGINT) AS version_after
  FROM m1)"""

SQL["manifest_gate"] = f"""
WITH {MANIFESTS},
a AS (SELECT *, CASE WHEN status = 'ok' THEN 'proceed'
                     WHEN status LIKE 'validation_error:%' OR status LIKE 'schema_contract_violation:%' THEN 'fail'
                     WHEN status LIKE 'checkpoint_write_interrupted:%' THEN 'resubmit' ELSE 'inspect' END AS action
      FROM manifests)
SELECT run_id, status, action, version_before, version_after,
       action = 'proceed' AND version_after IS NOT NULL AND version_after > COALESCE(
         MAX(CASE WHEN action = 'proceed' THEN version_after END)
           OVER (ORDER BY finished_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS gated
FROM a"""

SQL["failure_owner"] = f"""
WITH {MANIFESTS},
eo AS (SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(ts AS DATE) AS order_date,
              CAST(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) * -3
                        ELSE CAST(value AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS net_amount FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS calendar_date
        FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM eo) b WHERE lo IS NOT NULL),
dr AS (SELECT d.calendar_date, COALESCE(SUM(o.net_amount), 0) AS gross_revenue
       FROM cal d LEFT JOIN eo o ON o.order_date = d.calendar_date GROUP BY d.calendar_date),
st AS (SELECT status FROM manifests
       UNION ALL SELECT 'constraint_violation: non_negative_revenue' FROM dr WHERE NOT (gross_revenue >= 0)),
f AS (SELECT CASE WHEN status = 'ok' THEN NULL WHEN status LIKE 'schema_contract_violation:%' THEN 'table'
                  WHEN status LIKE 'constraint_violation:%' OR status LIKE 'refresh_error:%' THEN 'logic'
                  ELSE 'runtime' END AS owner, split_part(status, ':', 1) AS status_kind FROM st)
SELECT owner, status_kind, COUNT(*) AS failures FROM f WHERE owner IS NOT NULL GROUP BY ALL"""

SQL["image_pin_audit"] = """
WITH r AS (
  SELECT 'RUN-' || CAST(event_id AS VARCHAR) AS run_id,
         CASE event_type WHEN 'purchase' THEN 'lakehouse/ingest@sha256:' || sha256(props)
                         WHEN 'view' THEN 'lakehouse/ingest:latest'
                         WHEN 'click' THEN 'lakehouse/ingest:v1.4.2'
                         WHEN 'signup' THEN 'lakehouse/ingest'
                         ELSE 'lakehouse/ingest@sha256:' || upper(sha256(props)) END AS image,
         upper(substr(md5(props), 1, 6)) AS git_commit
  FROM events)
SELECT *, COALESCE(regexp_full_match(image, '[a-z0-9.\\-/:]+@sha256:[a-f0-9]{64}'), false) AS pinned FROM r"""

SQL["silver_orders_incremental"] = SQL["silver_orders"]
SQL["gold_refresh_incremental"] = SQL["gold_customer_value"]
SQL["silver_orders_bucketed"] = SQL["silver_orders"]

# winners among the first deliveries and among all; a row in both is no change
SQL["silver_change_feed"] = f"""
WITH {_orders_bronze(False)},
both_states AS (
  SELECT 1 AS change_weight, * FROM okeep
  UNION ALL
  SELECT -1, * FROM ob WHERE ingested_at = TIMESTAMP '2024-02-01 00:00:00')
SELECT source_event_id, order_id, lower(status_text) AS order_status, CAST(CAST(amount_text AS DECIMAL(18,2)) AS DOUBLE) AS net_amount,
       source_updated_at, CAST(SUM(change_weight) AS BIGINT) AS change_weight
FROM both_states GROUP BY ALL HAVING SUM(change_weight) <> 0"""

SQL["gold_counted_customer_value"] = SQL["gold_customer_value"]
SQL["gold_counted_daily_revenue"] = SQL["gold_daily_revenue"]
SQL["gold_counted_summary"] = SQL["gold_commercial_summary"]

SQL["external_count"] = f"""
WITH {EV}
SELECT source_page, CAST(source_page - 1 AS BIGINT) AS commit_version, COUNT(*) AS rows, MAX(source_updated_at) AS last_update
FROM ev WHERE source_page <= (SELECT floor((MAX(source_page) + 1) / 2) FROM ev) GROUP BY source_page"""

SQL["idempotent_pages"] = f"""
WITH {EV},
delivered AS (
  SELECT 'RUN-A' AS run, * FROM ev
  UNION ALL
  SELECT 'RUN-B', * FROM ev WHERE source_page % 3 = 1)
SELECT run AS ingestion_run_id, source_page, COUNT(*) AS rows, COUNT(DISTINCT source_event_id) AS events, MAX(source_updated_at) AS last_update
FROM delivered GROUP BY run, source_page"""
SQL["null_audit_stored"] = SQL["null_audit"]
SQL["pending_pages_bitmap"] = SQL["pending_pages"]
