"""DuckDB SQL with the result of each registered query, written from the tables up."""

from __future__ import annotations


def iso(x: str) -> str:
    return f"(strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({x}) % 1000000 <> 0 THEN strftime({x}, '.%f') ELSE '' END || '+00:00')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN round(CAST({a} AS DOUBLE) * 100 / {b} + 1e-9, 2) ELSE 0.0 END"


def r2(x: str) -> str:
    """Two decimals, halves away from zero, of a quotient of exact decimals that floating point may put just below the half."""
    return f"round({x} + CASE WHEN {x} < 0 THEN -1e-9 ELSE 1e-9 END, 2)"


def first(c: str) -> str:
    return f"arg_min({c}, row(occurred_ts, idempotency_key)) FILTER (WHERE {c} IS NOT NULL)"


def cents(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


_ORDER = "kind IN ('checkout_started', 'order_placed', 'order_cancelled', 'refund_issued')"

#: f: lifted records of the export with their identity, one row for each event, replay and second line.
BASE = f"""
WITH e0 AS (SELECT event_id AS n, ts, user_id AS u, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
  CASE event_type WHEN 'view' THEN CASE WHEN event_id % 6 = 0 THEN 'product_searched' ELSE 'product_viewed' END
    WHEN 'click' THEN CASE WHEN event_id % 8 = 0 THEN 'remove_from_cart' ELSE 'add_to_cart' END
    WHEN 'signup' THEN 'checkout_started' WHEN 'error' THEN 'payment_failed'
    ELSE CASE event_id % 10 WHEN 0 THEN 'order_cancelled' WHEN 1 THEN 'refund_issued' ELSE 'order_placed' END END AS kind FROM events),
c0 AS (SELECT *, 'first' AS copy, ts AS at_ts, k AS kk FROM e0
  UNION ALL SELECT *, 'replay', ts, k FROM e0 WHERE n % 20 = 0
  UNION ALL SELECT *, 'line', ts + INTERVAL 2 SECOND, (k + 1) % 100 FROM e0 WHERE kind = 'order_placed' AND n % 40 = 2),
c1 AS (SELECT n, CASE WHEN n % 499 <> 0 THEN {iso("at_ts")} END AS occurred_at, CASE WHEN n % 499 <> 0 THEN at_ts END AS occurred_ts,
  kind AS event_type, ['web', 'mobile_app', 'mobile_web', 'marketplace', 'store', 'api'][u % 6 + 1] AS channel,
  CASE WHEN n % 101 <> 0 THEN 'sess-' || u || '-' || strftime(ts, '%Y%m%d') END AS session_id, n % 5 AS seq, ['desktop', 'mobile', 'tablet'][u % 3 + 1] AS device_type, n_name AS country,
  CASE WHEN n % 501 <> 0 THEN 'sku-' || kk END AS product_id, p_name || CASE WHEN copy = 'replay' THEN ' (renamed)' ELSE '' END AS name, p_type AS category, p_brand AS brand,
  CASE WHEN n % 97 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS price, CASE WHEN n % 53 <> 0 THEN 'cust-' || u END AS customer_id, lower(c_mktsegment) AS segment,
  CASE WHEN {_ORDER} THEN 'ord-' || u || '-' || strftime(ts, '%Y%m%d') END AS order_id, CASE WHEN n % 211 = 0 THEN 500 ELSE 1 + n % 25 END AS quantity, n % 10 * 10 AS pct,
  CASE WHEN n % 307 = 0 THEN 'XXX' ELSE 'EUR' END AS currency, ['card', 'paypal', 'wallet'][n % 3 + 1] AS payment_method, 'camp-' || u % 5 AS campaign,
  {iso("at_ts + CASE WHEN copy = 'replay' THEN INTERVAL 3605 SECOND ELSE INTERVAL 5 SECOND END")} AS ingested_at
  FROM c0 LEFT JOIN part ON p_partkey = kk LEFT JOIN customer ON c_custkey = u LEFT JOIN nation ON c_nationkey = n_nationkey),
c2 AS (SELECT *, CAST(price * quantity AS DECIMAL(18,2)) AS gross FROM c1),
c3 AS (SELECT *, CAST(round(CAST(gross AS DECIMAL(18,2)) * CAST(pct AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS off FROM c2),
f AS (SELECT *, CAST(gross - off AS DOUBLE) AS net, concat_ws('-', event_type, product_id, occurred_at) AS event_id,
  sha1(concat_ws('|', event_type, coalesce(occurred_at, ''), coalesce(session_id, ''), seq, coalesce(product_id, ''), coalesce(customer_id, ''), coalesce(order_id, ''))) AS idempotency_key FROM c3)"""

_FLAT = """SELECT idempotency_key, event_id, event_type, occurred_ts, occurred_at, ingested_at, channel, device_type, CAST(NULL AS VARCHAR) AS device_os, session_id, seq AS event_sequence,
  product_id, product_id AS sku, trim(name) AS product_name, category, brand, CAST(price AS DOUBLE) AS product_price, customer_id, coalesce(segment, 'unknown') AS customer_segment, country AS customer_country, false AS is_returning,
  order_id, quantity, CAST(price AS DOUBLE) AS unit_price, CAST(pct AS DOUBLE) AS discount_pct, CAST(gross AS DOUBLE) AS gross_amount, coalesce(CAST(off AS DOUBLE), 0) AS discount_amount, net AS net_amount, currency, payment_method,
  campaign, 'search' AS utm_source, 'cpc' AS utm_medium FROM f"""

_DERIVED = """CASE WHEN product_price IS NULL THEN 'unknown' WHEN product_price < 50 THEN 'budget' WHEN product_price < 200 THEN 'mid' ELSE 'premium' END AS price_category,
  event_type = 'order_placed' AS is_revenue_event, event_type = 'order_placed' AS is_conversion,
  CASE WHEN event_type = 'order_placed' THEN coalesce(net_amount, 0) WHEN event_type IN ('order_cancelled', 'refund_issued') THEN 0 - coalesce(net_amount, 0) ELSE 0 END AS signed_net_amount,
  dayname(occurred_ts) AS day_of_week, isodow(occurred_ts) >= 6 AS is_weekend, strftime(occurred_ts, '%Y-%m-%d') AS partition_date, strftime(occurred_ts, '%H') AS partition_hour"""

#: t: flat columns; v: cleaned rows of t; d: derived.  a: the accepted ones;  s: silver.
FLAT = BASE + f",\nt AS ({_FLAT}),\nv AS (SELECT * REPLACE (CASE WHEN quantity BETWEEN 1 AND 100 THEN quantity ELSE 1 END AS quantity) FROM t WHERE product_id IS NOT NULL AND occurred_ts IS NOT NULL),\nd AS (SELECT *, {_DERIVED} FROM v)"
ACCEPTED = FLAT.replace("FROM f),\nv AS", "FROM f WHERE occurred_at IS NOT NULL AND product_id IS NOT NULL AND quantity BETWEEN 1 AND 100),\nv AS")
ONE = "QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at DESC) = 1"
SILVER = ACCEPTED + f",\ns AS (SELECT * FROM d {ONE})"

_SILVER_COLUMNS = "* REPLACE ({} AS occurred_ts)".format(stamp("occurred_ts"))

SESSIONS = f""",
g_sessions AS (SELECT *, epoch_us(date_trunc('second', session_end)) // 1000000 - epoch_us(date_trunc('second', session_start)) // 1000000 AS duration_seconds, orders > 0 AS converted, events = 1 AND views = 1 AS bounced,
  strftime(session_start, '%Y-%m-%d') AS partition_date FROM (
  SELECT session_id, {first("customer_id")} AS customer_id, {first("channel")} AS channel, {first("device_type")} AS device_type, {first("customer_country")} AS country, {first("campaign")} AS campaign, {first("utm_source")} AS utm_source,
  min(occurred_ts) AS session_start, max(occurred_ts) AS session_end, count(*) AS events, count(DISTINCT product_id) AS distinct_products,
  count(*) FILTER (WHERE event_type = 'product_viewed') AS views, count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds, count(*) FILTER (WHERE event_type = 'remove_from_cart') AS cart_removals,
  count(*) FILTER (WHERE event_type = 'checkout_started') AS checkouts, count(*) FILTER (WHERE event_type = 'payment_failed') AS payment_failures, count(*) FILTER (WHERE event_type = 'order_placed') AS orders,
  {cents("signed_net_amount")} AS revenue FROM s WHERE session_id IS NOT NULL GROUP BY session_id))"""

FUNNEL = f""",
g_funnel AS (SELECT partition_date, channel, sessions, customers, viewed, carted, checked_out, ordered, revenue, {pct("carted", "viewed")} AS view_to_cart_pct, {pct("checked_out", "carted")} AS cart_to_checkout_pct,
  {pct("ordered", "checked_out")} AS checkout_to_order_pct, {pct("ordered", "sessions")} AS overall_conversion_pct, CASE WHEN sessions > 0 THEN {r2('revenue / sessions')} ELSE 0.0 END AS revenue_per_session FROM (
  SELECT partition_date, channel, count(DISTINCT session_id) AS sessions, count(DISTINCT customer_id) AS customers, count(DISTINCT session_id) FILTER (WHERE event_type = 'product_viewed') AS viewed,
  count(DISTINCT session_id) FILTER (WHERE event_type = 'add_to_cart') AS carted, count(DISTINCT session_id) FILTER (WHERE event_type = 'checkout_started') AS checked_out,
  count(DISTINCT session_id) FILTER (WHERE event_type = 'order_placed') AS ordered, {cents("signed_net_amount")} AS revenue FROM s WHERE session_id IS NOT NULL GROUP BY partition_date, channel))"""

ORDERS = f""",
o1 AS (SELECT order_id, {", ".join(f"{first(c)} AS {n}" for c, n in (("customer_id", "customer_id"), ("session_id", "session_id"), ("channel", "channel"), ("device_type", "device_type"), ("customer_country", "country"), ("currency", "currency"), ("payment_method", "payment_method"), ("campaign", "campaign")))},
  min(occurred_ts) AS ordered_at, count(DISTINCT product_id) AS line_items, CAST(sum(quantity) AS BIGINT) AS units, {", ".join(f"coalesce({cents(c)}, 0) AS {c}" for c in ("gross_amount", "discount_amount", "net_amount"))}
  FROM s WHERE order_id IS NOT NULL AND event_type = 'order_placed' GROUP BY order_id),
o2 AS (SELECT order_id, bool_or(event_type = 'order_cancelled') AS c, bool_or(event_type = 'refund_issued') AS r, coalesce({cents("net_amount")}, 0) AS v FROM s WHERE event_type IN ('order_cancelled', 'refund_issued') GROUP BY order_id),
g_orders AS (SELECT o1.*, coalesce(c, false) AS cancelled, coalesce(r, false) AS refunded, coalesce(v, 0.0) AS reversed_amount, CASE WHEN c THEN 'cancelled' WHEN r THEN 'refunded' ELSE 'completed' END AS status,
  round(net_amount - coalesce(v, 0.0), 2) AS realized_revenue, CASE WHEN units > 0 THEN {r2('net_amount / units')} ELSE 0.0 END AS avg_item_value, strftime(ordered_at, '%Y-%m-%d') AS partition_date FROM o1 LEFT JOIN o2 USING (order_id))"""

RFM = f""",
r0 AS (SELECT customer_id, count(DISTINCT session_id) AS sessions, count(*) AS events, {first("customer_segment")} AS declared_segment, {first("customer_country")} AS country FROM s WHERE customer_id IS NOT NULL GROUP BY customer_id),
r1 AS (SELECT customer_id, count(*) AS orders, {cents("realized_revenue")} AS monetary, min(ordered_at) AS first_order_at, max(ordered_at) AS last_order_at, CAST(sum(units) AS BIGINT) AS units, {r2(cents("realized_revenue") + " / count(*)")} AS avg_order_value,
  count(*) FILTER (WHERE refunded) AS refunded_orders FROM g_orders WHERE customer_id IS NOT NULL AND status <> 'cancelled' GROUP BY customer_id),
r2 AS (SELECT *, date_diff('day', CAST(last_order_at AS DATE), CAST((SELECT max(occurred_ts) FROM s) AS DATE)) AS recency_days, {pct("refunded_orders", "orders")} AS refund_rate_pct FROM r1),
r3 AS (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score, ntile(5) OVER (ORDER BY orders, customer_id) AS f_score, ntile(5) OVER (ORDER BY monetary, customer_id) AS m_score FROM r2),
r4 AS (SELECT *, r_score + f_score + m_score AS rfm_score FROM r3),
g_rfm AS (SELECT r0.*, r4.* EXCLUDE (customer_id), CASE WHEN rfm_score IS NULL THEN NULL WHEN rfm_score >= 13 THEN 'champion' WHEN rfm_score >= 10 THEN 'loyal' WHEN rfm_score >= 7 THEN 'potential' WHEN r_score <= 2 THEN 'at_risk' ELSE 'hibernating' END AS rfm_segment,
  rfm_score IS NOT NULL AS is_buyer FROM r0 LEFT JOIN r4 USING (customer_id))"""

PRODUCTS = f""",
p0 AS (SELECT partition_date, product_id, {", ".join(f"{first(c)} AS {c}" for c in ("product_name", "category", "brand", "price_category"))}, {r2('avg(product_price)')} AS avg_price,
  count(*) FILTER (WHERE event_type = 'product_viewed') AS views, count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds, count(*) FILTER (WHERE event_type = 'order_placed') AS orders,
  CAST(coalesce(sum(quantity) FILTER (WHERE event_type = 'order_placed'), 0) AS BIGINT) AS units_sold, {cents("signed_net_amount")} AS revenue, count(DISTINCT customer_id) AS customers FROM s GROUP BY partition_date, product_id),
g_products AS (SELECT *, {pct("orders", "views")} AS view_to_order_pct, row_number() OVER (PARTITION BY partition_date ORDER BY revenue DESC, product_id) AS revenue_rank FROM p0)"""

ANOMALIES = """,
w AS (SELECT *, CASE WHEN session_id IS NOT NULL THEN lag(occurred_ts) OVER (PARTITION BY session_id ORDER BY occurred_ts, event_sequence, idempotency_key) END AS before FROM s),
x AS (SELECT *, list_filter([CASE WHEN net_amount > 5000 THEN 'high_amount' END, CASE WHEN quantity >= 20 THEN 'bulk_quantity' END, CASE WHEN discount_pct >= 80 THEN 'extreme_discount' END, CASE WHEN net_amount < 0 THEN 'negative_amount' END,
  CASE WHEN customer_id IS NULL THEN 'anonymous_purchase' END, CASE WHEN event_type = 'order_placed' AND epoch_us(date_trunc('second', occurred_ts)) - epoch_us(date_trunc('second', before)) < 5000000 THEN 'rapid_fire' END,
  CASE WHEN product_price IS NULL THEN 'missing_price' END], lambda z: z IS NOT NULL) AS why FROM w),
g_anomalies AS (SELECT partition_date, occurred_ts, event_type, idempotency_key, session_id, customer_id, product_id, order_id, quantity, discount_pct, net_amount, channel, array_to_string(why, ',') AS reasons,
  CASE WHEN len(why) >= 2 THEN 'high' ELSE 'low' END AS severity FROM x WHERE len(why) > 0)"""

REVENUE = f""",
v_revenue AS (SELECT partition_date AS day, channel, count(*) FILTER (WHERE event_type = 'order_placed') AS orders, count(DISTINCT customer_id) AS customers, {cents("signed_net_amount")} AS net_revenue,
  CAST(sum(CAST(signed_net_amount AS DECIMAL(18,2))) FILTER (WHERE event_type = 'order_placed') AS DOUBLE) AS gross_revenue,
  CAST(0 - sum(CAST(signed_net_amount AS DECIMAL(18,2))) FILTER (WHERE event_type IN ('order_cancelled', 'refund_issued')) AS DOUBLE) AS reversals FROM s GROUP BY partition_date, channel)"""

PERFORMANCE = f""",
v_products AS (SELECT product_id, max(product_name) AS product_name, max(category) AS category, max(brand) AS brand, {r2('avg(avg_price)')} AS avg_price, CAST(sum(views) AS BIGINT) AS lifetime_views, CAST(sum(cart_adds) AS BIGINT) AS lifetime_cart_adds,
  CAST(sum(units_sold) AS BIGINT) AS lifetime_units_sold, {cents("revenue")} AS lifetime_revenue, count(DISTINCT partition_date) AS active_days,
  CASE WHEN sum(views) > 0 THEN round(CAST(sum(units_sold) AS DOUBLE) * 100 / sum(views) + 1e-9, 2) END AS view_to_unit_pct FROM g_products GROUP BY product_id)"""

RECENT = f""",
v_recent AS (SELECT partition_date AS day, severity, reasons, count(*) AS events, {cents("net_amount")} AS amount_at_risk, count(DISTINCT customer_id) AS customers FROM g_anomalies
  WHERE CAST(partition_date AS DATE) >= (SELECT max(CAST(partition_date AS DATE)) FROM g_anomalies) - 30 GROUP BY ALL)"""

_CODES = """list_filter([CASE WHEN occurred_at IS NULL THEN 'missing:occurred_at' END, CASE WHEN product_id IS NULL THEN 'missing:product.product_id' END, CASE WHEN quantity NOT BETWEEN 1 AND 100 THEN 'out_of_range:order.quantity' END], lambda z: z IS NOT NULL)"""
_VOCABULARY = """list_filter([CASE WHEN currency NOT IN ('EUR', 'USD', 'GBP', 'CHF', 'CAD') THEN 'unknown_value:order.currency' END,
  CASE WHEN segment <> '' AND segment NOT IN ('new', 'returning', 'loyal', 'vip', 'churn_risk', 'unknown') THEN 'unknown_value:customer.segment' END], lambda z: z IS NOT NULL)"""
_ERRORS = f"""list_filter([CASE WHEN len({_CODES}) > 0 THEN 'schema_valid' END, CASE WHEN product_id IS NULL THEN 'product_id_present' END, CASE WHEN occurred_at IS NULL THEN 'timestamp_parseable' END,
  CASE WHEN quantity NOT BETWEEN 1 AND 100 THEN 'quantity_in_range' END], lambda z: z IS NOT NULL)"""
_WARNINGS = """list_filter([CASE WHEN customer_id IS NULL THEN 'customer_id_present' END, CASE WHEN currency = 'XXX' THEN 'known_currency' END, CASE WHEN price IS NULL THEN 'price_present' END,
  CASE WHEN occurred_ts > TIMESTAMP '2024-01-30 01:00:00' THEN 'timestamp_not_in_future' END, CASE WHEN session_id IS NULL THEN 'session_present' END], lambda z: z IS NOT NULL)"""
FLAGS = BASE + f",\nq AS (SELECT *, {_ERRORS} AS errors, {_WARNINGS} AS warnings FROM f)"

# The rules of a batch report.
_RULES = {
    "error": ["schema_valid", "product_id_present", "timestamp_parseable", "quantity_in_range", "amount_non_negative", "price_in_range"],
    "warn": ["customer_id_present", "known_event_type", "known_channel", "known_currency", "price_present", "amount_consistent", "timestamp_not_in_future", "session_present", "idempotency_key_present", "order_event_has_order_id"],
}
_RULE_ROWS = ", ".join(f"('{r}', '{s}')" for s, rules in _RULES.items() for r in rules)
_NULLABLE = ["customer_id", "session_id", "product_name", "category", "product_price", "order_id"]

_TIMES = "* REPLACE ({} AS ordered_at)".format(stamp("ordered_at"))
_SINCE = "CAST(partition_date AS DATE) >= (SELECT max(CAST(partition_date AS DATE)) FROM {t}) - {n}"

ORACLES = {
    "lift_flat": BASE + " SELECT event_id, occurred_at, event_type, channel, session_id, device_type, country, product_id, product_id AS sku, name, CAST(price AS DOUBLE) AS price, customer_id, segment, order_id, quantity, CAST(price AS DOUBLE) AS unit_price, CAST(pct AS DOUBLE) AS discount_pct, CAST(gross AS DOUBLE) AS gross_amount, CAST(off AS DOUBLE) AS discount_amount, net AS net_amount, currency, payment_method, campaign FROM f",
    "event_identity": BASE + " SELECT idempotency_key, event_id, ingested_at FROM f",
    "event_partitions": BASE + " SELECT coalesce(strftime(occurred_ts, '%Y-%m-%d'), 'unknown') AS dt, coalesce(strftime(occurred_ts, '%H'), 'unknown') AS hour, count(*) AS events FROM f GROUP BY 1, 2",
    "bronze_rejects": BASE + " SELECT idempotency_key, ingested_at, concat_ws(',', CASE WHEN occurred_at IS NULL THEN 'occurred_at_parsed' END, CASE WHEN product_id IS NULL THEN 'product_id_present' END, CASE WHEN quantity NOT BETWEEN 1 AND 100 THEN 'quantity_in_range' END) AS failed_checks FROM f WHERE occurred_at IS NULL OR product_id IS NULL OR quantity NOT BETWEEN 1 AND 100",
    "normalize_events": BASE + " SELECT idempotency_key, event_id, event_type, channel, occurred_at, name AS product_name, net AS amount, ingested_at FROM f WHERE occurred_at IS NOT NULL",
    "silver_flatten": FLAT + f" SELECT {_SILVER_COLUMNS} FROM t",
    "silver_clean": FLAT + f" SELECT idempotency_key, ingested_at, product_id, quantity, discount_pct, product_name, {stamp('occurred_ts')} AS occurred_ts FROM v",
    "silver_derive": FLAT + " SELECT idempotency_key, ingested_at, price_category, is_revenue_event, is_conversion, signed_net_amount, day_of_week, is_weekend, partition_date, partition_hour FROM d",
    "silver_dedupe": SILVER + " SELECT idempotency_key, ingested_at, product_name FROM s",
    "silver_events": SILVER + f" SELECT {_SILVER_COLUMNS} FROM s",
    "silver_window": SILVER + " SELECT idempotency_key, event_type, partition_date FROM s WHERE partition_date BETWEEN '2024-01-12' AND '2024-01-15'",
    "schema_errors": BASE + f" SELECT idempotency_key, ingested_at, array_to_string({_CODES} || {_VOCABULARY}, ',') AS errors FROM f",
    "quality_flags": FLAGS + " SELECT idempotency_key, ingested_at, array_to_string(errors, ',') AS errors, array_to_string(warnings, ',') AS warnings FROM q",
    "quality_rejects": FLAGS + " SELECT '2024-01-30 00:00:00' AS rejected_at, array_to_string(errors, ',') AS reasons, array_to_string(warnings, ',') AS warnings, idempotency_key, ingested_at FROM q WHERE len(errors) > 0",
    "quality_report": FLAGS + f", total AS (SELECT count(*) AS n, count(*) FILTER (WHERE len(errors) > 0) AS bad, count(*) FILTER (WHERE len(errors) = 0 AND len(warnings) > 0) AS warned FROM q), fails AS (SELECT unnest(errors || warnings) AS rule FROM q), per AS (SELECT rule, count(*) AS failed FROM fails GROUP BY rule) SELECT r.rule, r.severity, coalesce(failed, 0) AS failed, round(coalesce(failed, 0) * 100.0 / n, 2) AS failed_pct, CASE WHEN 100.0 * (n - bad) / n < 95 THEN 'fail' WHEN 100.0 * (n - bad) / n < 99 OR warned > 0 THEN 'warn' ELSE 'pass' END AS verdict FROM (VALUES {_RULE_ROWS}) r(rule, severity) LEFT JOIN per USING (rule), total",
    "silver_quality_summary": FLAT + f", s AS (SELECT * FROM d {ONE}), m AS (SELECT (SELECT count(*) FROM f) AS raw, (SELECT count(*) FROM v) AS cleaned, count(*) AS n, {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS null_{c}' for c in _NULLABLE)}, count(DISTINCT partition_date) AS days FROM s), k AS (SELECT string_agg(event_type || '=' || c, ',' ORDER BY event_type) AS events_by_type FROM (SELECT event_type, count(*) AS c FROM s GROUP BY event_type)) SELECT raw AS raw_records, n AS processed_records, greatest(raw - n, 0) AS dropped_records, cleaned - n AS duplicate_records, round(n * 100.0 / raw, 2) AS retention_pct, {', '.join(f'null_{c}, round(null_{c} * 100.0 / n, 2) AS null_pct_{c}' for c in _NULLABLE)}, days, events_by_type FROM m, k",
    "gold_sessions": SILVER + SESSIONS + f" SELECT * REPLACE ({stamp('session_start')} AS session_start, {stamp('session_end')} AS session_end) FROM g_sessions",
    "gold_funnel_daily": SILVER + FUNNEL + " SELECT * FROM g_funnel",
    "gold_orders": SILVER + ORDERS + f" SELECT {_TIMES} FROM g_orders",
    "gold_customer_rfm": SILVER + ORDERS + RFM + f" SELECT * REPLACE ({stamp('first_order_at')} AS first_order_at, {stamp('last_order_at')} AS last_order_at) FROM g_rfm",
    "gold_product_daily": SILVER + PRODUCTS + " SELECT * FROM g_products",
    "gold_product_top3": SILVER + PRODUCTS + " SELECT * FROM g_products WHERE revenue_rank <= 3",
    "gold_anomalies": SILVER + ANOMALIES + f" SELECT {_SILVER_COLUMNS} FROM g_anomalies",
    "merge_new_events": SILVER + " SELECT idempotency_key, event_type, partition_date, ingested_at, product_name, net_amount FROM s WHERE partition_date > '2024-01-10'",
    "catalog_products": "WITH a AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey AS VARCHAR) AS sku, p_name AS name, p_type AS category, p_brand AS brand, p_retailprice AS price, 0 AS r FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey AS VARCHAR) AS sku, upper(p_name) AS name, CAST(NULL AS VARCHAR) AS category, p_brand AS brand, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price, 1 AS r FROM part WHERE p_partkey % 7 <> 0) SELECT * EXCLUDE (r) FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY r) = 1",
    "view_revenue_daily": SILVER + REVENUE + " SELECT * FROM v_revenue",
    "view_funnel": SILVER + FUNNEL + " SELECT partition_date AS day, * EXCLUDE (partition_date, customers, revenue) FROM g_funnel",
    "view_customer_360": SILVER + SESSIONS + ORDERS + RFM + f", l AS (SELECT customer_id, {stamp('max(session_end)')} AS last_session_at, {r2('avg(revenue)')} AS revenue_per_session FROM g_sessions WHERE customer_id IS NOT NULL GROUP BY customer_id) SELECT customer_id, country, declared_segment, rfm_segment, recency_days, orders, monetary AS lifetime_revenue, avg_order_value, refund_rate_pct, is_buyer, sessions, last_session_at, revenue_per_session FROM g_rfm LEFT JOIN l USING (customer_id)",
    "view_product_performance": SILVER + PRODUCTS + PERFORMANCE + " SELECT * FROM v_products",
    "view_anomalies_recent": SILVER + ANOMALIES + RECENT + " SELECT * FROM v_recent",
    "q_revenue_month": SILVER + REVENUE + " SELECT day, channel, orders, net_revenue, reversals FROM v_revenue WHERE CAST(day AS DATE) >= date_trunc('month', (SELECT max(CAST(day AS DATE)) FROM v_revenue))",
    "q_funnel_leaks": SILVER + FUNNEL + f" SELECT channel, CAST(sum(viewed - carted) AS BIGINT) AS lost_view_to_cart, CAST(sum(carted - checked_out) AS BIGINT) AS lost_cart_to_checkout, CAST(sum(checked_out - ordered) AS BIGINT) AS lost_checkout_to_order FROM g_funnel WHERE {_SINCE.format(t='g_funnel', n=30)} GROUP BY channel",
    "q_segment_value": SILVER + ORDERS + RFM + f" SELECT rfm_segment, count(*) AS customers, {cents('monetary')} AS revenue_at_stake, round(avg(recency_days), 1) AS avg_days_since_last_order FROM g_rfm WHERE is_buyer GROUP BY rfm_segment",
    "q_viewed_not_bought": SILVER + PRODUCTS + PERFORMANCE + " SELECT product_name, category, lifetime_views, lifetime_units_sold, lifetime_revenue, view_to_unit_pct FROM v_products WHERE lifetime_views >= 10 ORDER BY view_to_unit_pct NULLS LAST, lifetime_views DESC, product_id LIMIT 20",
    "q_reconcile_orders": SILVER + ORDERS + f", k AS (SELECT DISTINCT order_id AS fact_id FROM s WHERE event_type = 'order_placed' AND order_id IS NOT NULL) SELECT partition_date AS day, count(*) AS orders_in_gold, count(fact_id) AS orders_in_facts, {cents('realized_revenue')} AS revenue_in_gold FROM g_orders LEFT JOIN k ON fact_id = order_id WHERE {_SINCE.format(t='g_orders', n=7)} GROUP BY partition_date",
    "q_session_quality": SILVER + SESSIONS + f" SELECT converted, count(*) AS sessions, round(avg(duration_seconds), 1) AS avg_seconds, round(avg(events), 1) AS avg_events, round(avg(distinct_products), 1) AS avg_products_seen, {r2('avg(revenue)')} AS avg_revenue FROM g_sessions WHERE {_SINCE.format(t='g_sessions', n=30)} GROUP BY converted",
    "q_anomaly_triage": SILVER + ANOMALIES + RECENT + " SELECT day, severity, reasons, events, amount_at_risk FROM v_recent WHERE CAST(day AS DATE) >= (SELECT max(CAST(day AS DATE)) FROM v_recent) - 7 ORDER BY amount_at_risk DESC NULLS LAST, day DESC, severity, reasons LIMIT 25",
}
# what the jobs and the stream leave, on other ways to the same rows
ORACLES |= {
    "drops_lifted": ORACLES["lift_flat"],
    "job_quarantine": ORACLES["bronze_rejects"],
    "job_silver_events": ORACLES["silver_events"],
    "job_gold_sessions": ORACLES["gold_sessions"],
    "job_gold_anomalies": ORACLES["gold_anomalies"],
    "stream_bronze": FLAGS + " SELECT idempotency_key, event_id, occurred_at, name AS product_name, net AS net_amount, strftime(occurred_ts, '%Y-%m-%d') AS dt, strftime(occurred_ts, '%H') AS hour FROM q WHERE len(errors) = 0 QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ingested_at) = 1",
    "catalog_customers": "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_custkey % 4 <> 1 AND c_custkey % 5 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS segment, CASE WHEN c_custkey % 4 = 1 THEN n_name END AS country, CASE WHEN c_custkey % 4 <> 1 THEN c_name END AS city FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
}

_ONE_TABLE = "event_type, product_id, product_name, product_price, customer_id, occurred_at, partition_date, partition_hour, price_category"
_LOADED = [("fact_events", "merge", "s", "0"), ("fact_sessions", "overwrite", "g_sessions", "0"), ("fact_orders", "append", "g_orders", "0"), ("customer_segments", "overwrite", "g_rfm", "0"), ("fact_anomalies", "overwrite", "g_anomalies", "0")]
ORACLES |= {
    "load_outcome": SILVER + SESSIONS + ORDERS + RFM + ANOMALIES + "".join(f" SELECT '{t}' AS table_name, 'loaded' AS status, '{mode}' AS mode, count(*) AS n_rows, count(*) AS inserted, CAST({again} AS BIGINT) AS inserted_again FROM {of} UNION ALL" for t, mode, of, again in _LOADED) + " SELECT 'gone', 'skipped', NULL, 0, 0, 0",
    "load_one_table": SILVER + f" SELECT {_ONE_TABLE} FROM (SELECT {_SILVER_COLUMNS} FROM s)",
    "load_customer_rfm": ORACLES["gold_customer_rfm"],
    "catalog_counts": "WITH a AS (SELECT p_partkey, p_name IS NOT NULL AND p_retailprice >= 0 AS fit FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey, p_partkey % 7 <> 0 AND p_name IS NOT NULL AND p_retailprice >= 0 AS fit FROM part), n AS (SELECT 'first' AS source, count(*) AS rows, count(*) FILTER (WHERE fit) AS usable, count(DISTINCT p_partkey) FILTER (WHERE fit) AS taken FROM a UNION ALL SELECT 'second', count(*), count(*) FILTER (WHERE fit), count(DISTINCT p_partkey) FILTER (WHERE fit AND p_partkey NOT IN (SELECT p_partkey FROM a WHERE fit)) FROM b) SELECT *, rows - usable AS dropped, usable - taken AS repeated FROM n",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
