"""The registered queries as DuckDB SQL over the raw test tables.

Written apart from the Spark plans: money is integer cents, keys come from
row_number, joins go to the fact itself and nothing is pre-aggregated.
"""

from __future__ import annotations


def half_up(num: str, den: str, places: int = 2) -> str:
    """num / den rounded half away from zero, as DOUBLE; null for a zero denominator."""
    scale = 10**places
    units = (
        f"(2 * abs(CAST({num} AS HUGEINT)) * {scale} + ({den}))"
        f" // nullif(2 * CAST({den} AS HUGEINT), 0)"
    )
    return f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END * CAST({units} AS DOUBLE) / {scale})"


def pct(part: str, whole: str) -> str:
    return half_up(f"(100 * ({part}))", f"({whole})")


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def mean_cents(total: str, n: str) -> str:
    """Mean of cents over n, as currency with two decimals."""
    return f"({half_up(total, n, 0)} / 100)"


# -- raw tables as CTEs ------------------------------------------------------

_CHANNEL = """CASE WHEN payment_type IS NULL THEN 'Unknown' WHEN payment_type = 'credit_card'
 THEN 'Web' WHEN payment_type = 'boleto' THEN 'Mobile' ELSE 'Other' END"""

_ORDERS = {
    "plain": """raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ts,
    CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS order_status
  FROM orders)""",
    "graded": """raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey || '-' || year(o_orderdate) AS customer_id,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ts,
    CASE WHEN dayofyear(o_orderdate) <= CASE o_orderpriority WHEN '1-URGENT' THEN 4
      WHEN '2-HIGH' THEN 11 WHEN '3-MEDIUM' THEN 25 WHEN '4-NOT SPECIFIED' THEN 25 ELSE 55 END
      THEN 'canceled' ELSE 'delivered' END AS order_status
  FROM orders)""",
}
_ITEMS = {
    "plain": """raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c, 600 AS ratio_m
  FROM lineitem)""",
    "graded": """raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c,
    730 + 12 * CAST(substr(p_brand, 7) AS INTEGER) AS ratio_m
  FROM lineitem JOIN part ON p_partkey = l_partkey)""",
}
_CUSTOMERS = {
    "plain": """raw_customers AS (
  SELECT c_custkey AS customer_id, n_name AS country
  FROM customer JOIN nation ON n_nationkey = c_nationkey)""",
    "graded": """raw_customers AS (
  SELECT DISTINCT c_custkey || '-' || coalesce(year(o_orderdate), 0) AS customer_id,
    n_name AS country
  FROM customer JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN orders ON o_custkey = c_custkey)""",
}
_REST = f"""raw_payments AS (
  SELECT o_orderkey AS order_id, 0 AS seq, NULL AS payment_type,
    CAST(round(o_totalprice * 100) AS BIGINT) AS value_c FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey, 1, CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card'
    WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher' ELSE 'debit_card' END,
    CAST(round(o_totalprice * 100) AS BIGINT) FROM orders WHERE o_orderpriority <> '5-LOW'),
payments AS (
  SELECT order_id, arg_min(payment_type, seq) FILTER (WHERE payment_type IS NOT NULL)
    AS payment_type, sum(value_c) AS value_c
  FROM raw_payments GROUP BY order_id),
headers AS (
  SELECT o.order_id, o.customer_id, CAST(o.ts AS DATE) AS order_date,
    CASE WHEN o.order_status = 'delivered' THEN 'Success' ELSE 'Failed' END AS payment_status,
    {_CHANNEL} AS channel
  FROM raw_orders o LEFT JOIN payments p ON p.order_id = o.order_id),
items AS (
  SELECT * FROM raw_items QUALIFY row_number() OVER (
    PARTITION BY order_id, order_item_id ORDER BY product_id, price_c) = 1),
priced AS (
  SELECT *, (2 * price_c * 20 + 100) // 200 AS revenue_c,
    (2 * price_c * 20 * ratio_m + 100000) // 200000 AS cost_c FROM items),
clean_fact AS (
  SELECT i.order_id, h.order_date, h.customer_id, i.product_id, 1 AS quantity, revenue_c, cost_c,
    revenue_c - cost_c AS profit_c, h.payment_status, h.channel
  FROM priced i JOIN headers h ON h.order_id = i.order_id
  WHERE h.order_date IS NOT NULL AND h.customer_id IS NOT NULL AND i.product_id IS NOT NULL
    AND revenue_c > 0),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY c.customer_id) AS customer_key, c.customer_id, c.country,
    s.signup_date, CASE WHEN coalesce(s.n, 0) <= 1 THEN 'New' WHEN s.n <= 5 THEN 'Returning'
      ELSE 'VIP' END AS segment
  FROM raw_customers c LEFT JOIN (
    SELECT customer_id, CAST(min(ts) AS DATE) AS signup_date, count(*) AS n
    FROM raw_orders GROUP BY customer_id) s ON s.customer_id = c.customer_id),
categories AS (
  SELECT p_partkey AS product_id,
    CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 1 AND 20
      THEN 'category_' || substr(p_brand, 7) ELSE 'Other' END AS category
  FROM part),
prices AS (
  SELECT product_id, count(*) AS price_count,
    (2 * CAST(sum(price_c) AS HUGEINT) * 20 + 100 * count(*)) // (200 * count(*)) AS unit_price_c
  FROM raw_items GROUP BY product_id),
dim_product AS (
  SELECT row_number() OVER (ORDER BY c.product_id) AS product_key, c.product_id, c.category,
    'Generic' AS brand, (2 * unit_price_c * 6 + 10) // 20 AS unit_cost_c, unit_price_c
  FROM categories c LEFT JOIN prices p ON p.product_id = c.product_id),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS weekday
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM raw_orders WHERE ts IS NOT NULL)),
fact_orders AS (
  SELECT f.*, CAST(strftime(f.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
    c.customer_key, p.product_key
  FROM clean_fact f JOIN dim_customer c ON c.customer_id = f.customer_id
    JOIN dim_product p ON p.product_id = f.product_id),
wide AS (
  SELECT f.order_id, f.revenue_c, f.profit_c, f.channel, f.payment_status, d.date, d.year,
    d.month, c.customer_key, c.customer_id, c.segment, c.country, p.product_key, p.product_id,
    p.category
  FROM fact_orders f JOIN dim_customer c ON c.customer_key = f.customer_key
    JOIN dim_product p ON p.product_key = f.product_key
    JOIN dim_date d ON d.date_key = f.order_date_key),
sales AS (SELECT * FROM wide WHERE payment_status = 'Success')"""


def _with(name: str, select: str, *ctes: str) -> str:
    parts = [_ORDERS[name], _ITEMS[name], _CUSTOMERS[name], _REST, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _plain(select: str, *ctes: str) -> str:
    return _with("plain", select, *ctes)


def _graded(select: str, *ctes: str) -> str:
    return _with("graded", select, *ctes)


_SUM_R, _SUM_P = "sum(revenue_c)", "sum(profit_c)"
_MARGIN = pct(_SUM_P, _SUM_R)
_FAILED = "count(*) FILTER (WHERE payment_status = 'Failed')"
_PAID = "count(*) FILTER (WHERE payment_status = 'Success')"
_PAID_R = "coalesce(sum(revenue_c) FILTER (WHERE payment_status = 'Success'), 0)"
_LOST_R = "coalesce(sum(revenue_c) FILTER (WHERE payment_status = 'Failed'), 0)"

_ITEM_SUMS = f"""count(*) AS items, {money(_SUM_R)} AS revenue, {money(_SUM_P)} AS profit"""

_FACT_OUT = f"""quantity, {money('revenue_c')} AS revenue, {money('cost_c')} AS cost,
 {money('profit_c')} AS profit, payment_status, channel"""
_CLEAN_FACT = f"SELECT order_id, order_date, customer_id, product_id, {_FACT_OUT} FROM clean_fact"
_KEYED_FACT = (
    f"SELECT order_id, order_date_key, customer_key, product_key, {_FACT_OUT} FROM fact_orders"
)


# -- reports reused by several queries ---------------------------------------


def _monthly(extra: str = "") -> str:
    return f"""SELECT year, month, {extra} count(DISTINCT order_id) AS order_count,
 {money(_SUM_R)} AS total_revenue, {money(_SUM_P)} AS total_profit, {_MARGIN} AS profit_margin_pct
 FROM sales GROUP BY year, month"""


_YEAR_MONTH = "printf('%d-%02d', year, month) AS year_month,"


def _category_report(limit: int) -> str:
    return f"""SELECT category, count(*) AS order_count, {money(_SUM_R)} AS total_revenue,
 {money(_SUM_P)} AS total_profit, {_MARGIN} AS profit_margin_pct
 FROM sales GROUP BY category ORDER BY sum(revenue_c) DESC, category LIMIT {limit}"""


def _top_customers(profit: str = "") -> str:
    return f"""SELECT customer_id, segment, country, count(DISTINCT order_id) AS order_count,
 {money(_SUM_R)} AS total_revenue, {profit} {mean_cents(_SUM_R, 'count(*)')} AS avg_order_value
 FROM sales GROUP BY customer_id, segment, country
 ORDER BY sum(revenue_c) DESC, customer_id LIMIT 10"""


_CHANNEL_REPORT = f"""SELECT channel, count(*) AS total_orders, {_PAID} AS successful_orders,
 {money(_PAID_R)} AS revenue, {pct(_FAILED, 'count(*)')} AS failure_rate_pct
 FROM wide GROUP BY channel"""

_SEGMENT_REPORT = f"""SELECT c.segment, count(DISTINCT c.customer_key) AS customer_count,
 count(DISTINCT s.order_id) AS order_count, {money(_SUM_R)} AS total_revenue,
 {mean_cents(_SUM_R, 'count(s.order_id)')} AS avg_order_value
 FROM dim_customer c LEFT JOIN sales s ON s.customer_key = c.customer_key GROUP BY c.segment"""

_REVENUE_PER_CUSTOMER = f"""SELECT segment, count(DISTINCT customer_key) AS customer_count,
 {money(_SUM_R)} AS total_revenue, {mean_cents(_SUM_R, 'count(*)')} AS avg_revenue_per_order,
 {mean_cents(_SUM_R, 'count(DISTINCT customer_key)')} AS revenue_per_customer
 FROM sales GROUP BY segment"""

_FAILED_BY_CHANNEL = f"""SELECT channel, count(*) AS total_orders, {_FAILED} AS failed_orders,
 {pct(_FAILED, 'count(*)')} AS failed_payment_pct FROM wide GROUP BY channel"""

_ORDER_VALUE = f"""SELECT {mean_cents(_SUM_R, 'count(*)')} AS avg_order_value,
 {money('min(revenue_c)')} AS min_order_value, {money('max(revenue_c)')} AS max_order_value
 FROM sales"""

_EXECUTIVE = f"""SELECT {money(_SUM_R + " FILTER (WHERE payment_status = 'Success')")}
 AS total_revenue, {money(_SUM_P + " FILTER (WHERE payment_status = 'Success')")} AS total_profit,
 (SELECT {_MARGIN} FROM sales) AS profit_margin, {pct(_PAID, 'count(*)')} AS order_success_rate,
 count(*) AS total_orders, {_PAID} AS successful_orders FROM wide"""


def _retention(cross_year: bool) -> str:
    same = "" if cross_year else "AND a.year = b.year"
    return _plain(
        f"""SELECT a.year, a.month, count(DISTINCT a.customer_key) AS current_customers,
 count(DISTINCT b.customer_key) AS retained_customers,
 {pct('count(DISTINCT b.customer_key)', 'count(DISTINCT a.customer_key)')} AS retention_rate_pct
 FROM buyers a LEFT JOIN buyers b ON a.customer_key = b.customer_key
  AND a.year * 12 + a.month = b.year * 12 + b.month + 1 {same}
 GROUP BY a.year, a.month""",
        "buyers AS (SELECT DISTINCT year, month, customer_key FROM sales)",
    )


_ACTIVITY = """SELECT customer_key, segment, min(date) AS first_order_date,
 max(date) AS last_order_date, count(DISTINCT order_id) AS total_orders,
 CAST(max(date) - min(date) AS INTEGER) AS days_active FROM sales GROUP BY customer_key, segment"""

_RANKED = f"""ranked AS (
 SELECT *, percent_rank() OVER (ORDER BY total_revenue DESC) AS revenue_percentile,
  percent_rank() OVER (ORDER BY profit_margin_pct DESC) AS margin_percentile
 FROM (SELECT category, count(DISTINCT order_id) AS order_count, {money(_SUM_R)} AS total_revenue,
  {money(_SUM_P)} AS total_profit, {_MARGIN} AS profit_margin_pct,
  {mean_cents(_SUM_R, 'count(DISTINCT order_id)')} AS avg_order_value
  FROM sales GROUP BY category))"""


# -- insights ----------------------------------------------------------------


def _dollars(x: str) -> str:
    return f"format('{{:,.0f}}', {x})"


def _tenth(x: str) -> str:
    return f"format('{{:.1f}}', {x})"


def _rule_low_margin() -> str:
    return f"""SELECT 1 AS rule_order,
 CAST(row_number() OVER (ORDER BY rev DESC, cat) AS INTEGER) AS rank, 'warning' AS type,
 'Product Performance' AS category, 'Low Margin Alert: ' || cat AS title,
 'Category ''' || cat || ''' has ' || {_tenth('m')} || '% margin (below 10.0% threshold) with $'
 || {_dollars('rev')} || ' revenue' AS message,
 CASE WHEN m < 5 THEN 'high' ELSE 'medium' END AS severity
 FROM (SELECT category AS cat, {money(_SUM_R)} AS rev, {_MARGIN} AS m FROM sales GROUP BY category)
 WHERE m < 10"""


def _rule_failed() -> str:
    return f"""SELECT 2 AS rule_order,
 CAST(row_number() OVER (ORDER BY rate DESC, channel) AS INTEGER) AS rank, 'alert' AS type,
 'Payment Operations' AS category, 'High Failure Rate: ' || channel || ' Channel' AS title,
 channel || ' channel has ' || {_tenth('rate')} || '% payment failure rate, losing $'
 || {_dollars('lost')} || ' in revenue' AS message,
 CASE WHEN rate > 10 THEN 'high' ELSE 'medium' END AS severity
 FROM (SELECT channel, {pct(_FAILED, 'count(*)')} AS rate, {money(_LOST_R)} AS lost
  FROM wide GROUP BY channel) WHERE rate > 5"""


def _rule_retention(limit: int) -> str:
    return f"""SELECT 3 AS rule_order,
 CAST(row_number() OVER (ORDER BY share DESC, segment) AS INTEGER) AS rank, 'info' AS type,
 'Customer Retention' AS category, 'Retention Concern: ' || segment || ' Segment' AS title,
 {_tenth('share')} || '% of ' || segment || ' customers (' || format('{{:,}}', once)
 || ') made only one purchase' AS message, 'medium' AS severity
 FROM (SELECT segment, count(*) FILTER (WHERE n = 1) AS once,
   {pct('count(*) FILTER (WHERE n = 1)', 'count(*)')} AS share
  FROM (SELECT c.segment, c.customer_key, count(DISTINCT s.order_id) AS n FROM dim_customer c
   LEFT JOIN sales s ON s.customer_key = c.customer_key GROUP BY c.segment, c.customer_key)
  GROUP BY segment) WHERE share > {limit}"""


def _rule_review() -> str:
    return f"""SELECT 4 AS rule_order, 1 AS rank, 'recommendation' AS type,
 'Category Management' AS category, 'Categories to Review for Discontinuation' AS title,
 'Consider reviewing these low-revenue, low-margin categories: '
 || string_agg(cat, ', ' ORDER BY rev, cat) AS message, 'low' AS severity
 FROM (SELECT cat, rev FROM (
   SELECT category AS cat, {_SUM_R} AS rev, {_MARGIN} AS m,
    percent_rank() OVER (ORDER BY {_SUM_R}) AS place FROM sales GROUP BY category)
  WHERE place < 0.2 AND m < 15 ORDER BY rev, cat LIMIT 5) HAVING count(*) > 0"""


def _rule_top() -> str:
    return f"""SELECT 5 AS rule_order, 1 AS rank, 'success' AS type, 'Top Performers' AS category,
 'Top Category: ' || cat AS title, 'Generated $' || {_dollars('rev')} || ' in revenue with $'
 || {_dollars('profit')} || ' profit' AS message, 'low' AS severity
 FROM (SELECT category AS cat, {money(_SUM_R)} AS rev, {money(_SUM_P)} AS profit
  FROM sales GROUP BY category ORDER BY {_SUM_R} DESC, category LIMIT 1)"""


def _all_rules() -> str:
    rules = [_rule_low_margin(), _rule_failed(), _rule_retention(70), _rule_review(), _rule_top()]
    union = " UNION ALL ".join(f"SELECT * FROM ({rule})" for rule in rules)
    return f"insights AS ({union})"


# -- payload as JSON text ----------------------------------------------------


def _cents_text(c: str) -> str:
    return (
        f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || (abs({c}) // 100) || '.'"
        f" || lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))"
    )


def _two_places(x: str) -> str:
    return _cents_text(f"CAST(round({x} * 100) AS HUGEINT)")


def _quoted(x: str) -> str:
    return f"""('"' || {x} || '"')"""


def _json_array(x: str, order: str) -> str:
    return f"""('[' || coalesce(string_agg({x}, ',' ORDER BY {order}), '') || ']')"""


def _json_columns(source: str, order: str, fields: dict[str, str]) -> str:
    arrays = " || ',' || ".join(
        f"""'"{name}":' || {_json_array(text, order)}""" for name, text in fields.items()
    )
    return f"(SELECT '{{' || {arrays} || '}}' FROM ({source}))"


def _json_rows(source: str, order: str, fields: dict[str, str]) -> str:
    pairs = " || ',' || ".join(f"""'"{name}":' || {text}""" for name, text in fields.items())
    row = f"('{{' || {pairs} || '}}')"
    return f"(SELECT {_json_array(row, order)} FROM ({source}))"


def _int(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _payload() -> str:
    rev, profit = _two_places("total_revenue"), _two_places("total_profit")
    by_revenue = "total_revenue DESC"
    kpis = f"""(SELECT '{{"total_revenue":' || {rev} || ',"total_profit":' || {profit}
 || ',"profit_margin":' || {_two_places('profit_margin')}
 || ',"order_success_rate":' || {_two_places('order_success_rate')}
 || ',"total_orders":' || total_orders || ',"successful_orders":' || successful_orders || '}}'
 FROM ({_EXECUTIVE}))"""
    parts = {
        "kpis": kpis,
        "trends": _json_columns(
            _monthly(_YEAR_MONTH),
            "year, month",
            {
                "year_month": _quoted("year_month"), "revenue": rev, "profit": profit,
                "orders": _int("order_count"),
            },
        ),
        "categories": _json_columns(
            _category_report(15),
            f"{by_revenue}, category",
            {
                "category": _quoted("category"), "revenue": rev, "profit": profit,
                "margin": _two_places("profit_margin_pct"), "orders": _int("order_count"),
            },
        ),
        "segments": _json_columns(
            _SEGMENT_REPORT,
            f"{by_revenue}, segment",
            {
                "segment": _quoted("segment"), "customer_count": _int("customer_count"),
                "order_count": _int("order_count"), "revenue": rev,
                "avg_order_value": _two_places("avg_order_value"),
            },
        ),
        "top_customers": _json_rows(
            _top_customers(),
            f"{by_revenue}, customer_id",
            {
                "customer_id": _quoted("customer_id"), "segment": _quoted("segment"),
                "country": _quoted("country"), "order_count": _int("order_count"),
                "total_revenue": rev, "avg_order_value": _two_places("avg_order_value"),
            },
        ),
        "channels": _json_columns(
            _CHANNEL_REPORT,
            "revenue DESC, channel",
            {
                "channel": _quoted("channel"), "total_orders": _int("total_orders"),
                "successful_orders": _int("successful_orders"), "revenue": _two_places("revenue"),
                "failure_rate": _two_places("failure_rate_pct"),
            },
        ),
        "insights": _json_rows(
            "SELECT * FROM insights",
            "rule_order, rank",
            {c: _quoted(c) for c in ["type", "category", "title", "message", "severity"]},
        ),
    }
    body = " || ',' || ".join(f"""'"{name}":' || {text}""" for name, text in parts.items())
    return _graded(f"SELECT '{{' || {body} || '}}' AS value", _all_rules())


# -- checks ------------------------------------------------------------------


def _union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


_TABLES = ["fact_orders", "dim_customer", "dim_product", "dim_date"]
_ROW_COUNTS = _union(
    [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES]
)
_ORPHANS = _union(
    [
        f"""SELECT '{fk}' AS foreign_key, '{t}' AS table_name, count(*) AS orphans
 FROM fact_orders f LEFT JOIN {t} d ON d.{k} = f.{fk} WHERE d.{k} IS NULL"""
        for fk, t, k in [
            ("customer_key", "dim_customer", "customer_key"),
            ("product_key", "dim_product", "product_key"),
            ("order_date_key", "dim_date", "date_key"),
        ]
    ]
)
_MANDATORY = {
    "dim_date": {c: c for c in ["date", "year", "month", "quarter", "weekday"]},
    "dim_customer": {"customer_id": "customer_id"},
    "dim_product": {"product_id": "product_id"},
    "fact_orders": {
        "order_id": "order_id", "order_date_key": "order_date_key",
        "customer_key": "customer_key", "product_key": "product_key", "quantity": "quantity",
        "revenue": "revenue_c", "cost": "cost_c", "profit": "profit_c",
    },
}
_NULLS = _union(
    [
        f"""SELECT '{t}' AS table_name, '{name}' AS column_name,
 count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {t}"""
        for t, columns in _MANDATORY.items()
        for name, c in columns.items()
    ]
)
_DUPLICATES = _union(
    [
        f"""SELECT '{t}' AS table_name, '{keys}' AS key_columns, count(*) AS duplicate_keys,
 CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
 FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys}) WHERE n > 1"""
        for t, keys in [
            ("dim_date", "date_key"),
            ("dim_customer", "customer_key"),
            ("dim_customer", "customer_id"),
            ("dim_product", "product_key"),
            ("dim_product", "product_id"),
            ("fact_orders", "order_id, product_key"),
        ]
    ]
)
_DOMAINS = _union(
    [
        """SELECT 'dim_customer' AS table_name, 'segment' AS column_name,
 count(*) FILTER (WHERE segment NOT IN ('New', 'Returning', 'VIP')) AS bad_rows
 FROM dim_customer""",
        """SELECT 'fact_orders', 'payment_status',
 count(*) FILTER (WHERE payment_status NOT IN ('Success', 'Failed')) FROM fact_orders""",
    ]
)
_VALIDATION = f"""SELECT 'row_count' AS check_name, table_name, '*' AS subject, row_count AS n
 FROM ({_ROW_COUNTS})
UNION ALL SELECT 'orphans', table_name, foreign_key, orphans FROM ({_ORPHANS})
UNION ALL SELECT 'nulls', table_name, column_name, null_rows FROM ({_NULLS})
UNION ALL SELECT 'duplicates', table_name, key_columns, extra_rows FROM ({_DUPLICATES})
UNION ALL SELECT 'domain', table_name, column_name, bad_rows FROM ({_DOMAINS})
UNION ALL SELECT 'mixed_orders', 'fact_orders', 'order_id', count(*) FROM (
 SELECT order_id FROM fact_orders GROUP BY order_id
 HAVING count(DISTINCT (order_date_key, customer_key, payment_status, channel)) > 1)"""

# A star with every kind of fault; sources.driver_tables.broken_star makes the same.
_BROKEN = [
    """b_fact AS (SELECT order_id,
  CASE WHEN order_id % 17 = 0 THEN 19000101 ELSE order_date_key END AS order_date_key,
  CASE WHEN order_id % 11 = 0 THEN -customer_key ELSE customer_key END AS customer_key,
  CASE WHEN order_id % 13 = 0 THEN NULL ELSE product_key END AS product_key, quantity,
  CASE WHEN order_id % 19 = 0 THEN NULL ELSE revenue_c END AS revenue_c, cost_c, profit_c,
  CASE WHEN product_key % 23 = 0 THEN 'Refunded' ELSE payment_status END AS payment_status, channel
 FROM fact_orders)""",
    """b_customer AS (SELECT customer_key,
  CASE WHEN customer_key % 29 = 0 THEN NULL ELSE customer_id END AS customer_id, country, signup_date,
  CASE WHEN customer_key % 7 = 0 THEN 'Gold' ELSE segment END AS segment FROM dim_customer
 UNION ALL SELECT * FROM dim_customer WHERE customer_key % 31 = 0)""",
    """b_product AS (SELECT product_key,
  CASE WHEN product_key % 37 = 0 THEN NULL ELSE product_id END AS product_id, category, brand,
  unit_cost_c, unit_price_c FROM dim_product WHERE product_key % 41 <> 0)""",
    """b_date AS (SELECT date_key, date, year, month, quarter,
  CASE WHEN date_key % 100 = 1 THEN NULL ELSE weekday END AS weekday FROM dim_date
 UNION ALL SELECT * FROM dim_date WHERE date_key % 100 = 2)""",
]


def _broken(select: str) -> str:
    return _with(
        "plain",
        f"""SELECT * FROM (WITH fact_orders AS (SELECT * FROM b_fact),
 dim_customer AS (SELECT * FROM b_customer), dim_product AS (SELECT * FROM b_product),
 dim_date AS (SELECT * FROM b_date) {select})""",
        *_BROKEN,
    )


def _audit(raw_customers: str) -> str:
    counts = {
        "read_orders": "SELECT count(*) FROM raw_orders",
        "read_order_items": "SELECT count(*) FROM raw_items",
        "read_customers": raw_customers,
        "read_products": "SELECT count(*) FROM part",
        "read_payments": "SELECT count(*) FROM raw_payments",
        "read_category_translation": "SELECT 20",
        "items_unique": "SELECT count(*) FROM items",
        "items_repeated": "SELECT (SELECT count(*) FROM raw_items) - (SELECT count(*) FROM items)",
        "items_incomplete": """SELECT count(*) FROM items i LEFT JOIN headers h
 ON h.order_id = i.order_id WHERE h.order_date IS NULL OR h.customer_id IS NULL
 OR i.product_id IS NULL""",
        "fact_orders": "SELECT count(*) FROM clean_fact",
        "dim_customer": "SELECT count(*) FROM dim_customer",
        "dim_product": "SELECT count(*) FROM dim_product",
        "dim_date": "SELECT count(*) FROM dim_date",
    }
    return _union(
        [f"SELECT '{stage}' AS stage, CAST(({sql}) AS BIGINT) AS n_rows" for stage, sql in counts.items()]
    )


_PROFILE = """SELECT 'customers_' || segment AS metric, CAST(count(*) AS VARCHAR) AS value
 FROM dim_customer GROUP BY segment
UNION ALL SELECT 'categories', CAST(count(DISTINCT category) AS VARCHAR) FROM dim_product
UNION ALL SELECT 'first_date', CAST(min(date) AS VARCHAR) FROM dim_date
UNION ALL SELECT 'last_date', CAST(max(date) AS VARCHAR) FROM dim_date"""

_DIM_PRODUCT = f"""SELECT product_key, product_id, category, brand,
 {money('unit_cost_c')} AS unit_cost, {money('unit_price_c')} AS unit_price FROM dim_product"""

# From CSV files, ids are text, and dense keys follow the order of the text.
_CSV_FACT = f"""SELECT CAST(order_id AS VARCHAR) AS order_id, order_date,
 CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id,
 {_FACT_OUT} FROM clean_fact"""
_PRODUCT_MONEY = f"{money('unit_cost_c')} AS unit_cost, {money('unit_price_c')} AS unit_price"
_CSV_CUSTOMER = """SELECT row_number() OVER (ORDER BY CAST(customer_id AS VARCHAR)) AS customer_key,
 CAST(customer_id AS VARCHAR) AS customer_id, country, signup_date, segment FROM dim_customer"""
_CSV_PRODUCT = f"""SELECT row_number() OVER (ORDER BY CAST(product_id AS VARCHAR)) AS product_key,
 CAST(product_id AS VARCHAR) AS product_id, category, brand, {_PRODUCT_MONEY} FROM dim_product"""
_CSV_CUSTOMER_KEYS = """SELECT customer_key, CAST(customer_id AS VARCHAR) AS customer_id, country,
 signup_date, segment FROM dim_customer"""
_CSV_PRODUCT_KEYS = f"""SELECT product_key, CAST(product_id AS VARCHAR) AS product_id, category, brand,
 {_PRODUCT_MONEY} FROM dim_product"""

_CHANNEL_FAILURE = f"""SELECT channel, count(*) AS total_orders, {_PAID} AS successful_orders,
 {_FAILED} AS failed_orders, {pct(_FAILED, 'count(*)')} AS failure_rate_pct,
 {money(_PAID_R)} AS successful_revenue, {money(_LOST_R)} AS lost_revenue,
 CASE WHEN {_FAILED} * 100 > 5 * count(*) THEN 'HIGH FAILURE'
  WHEN {_FAILED} * 100 > 2 * count(*) THEN 'MODERATE FAILURE' ELSE 'LOW FAILURE' END
  AS failure_status FROM wide GROUP BY channel"""

_PRODUCT_MARGIN = f"""SELECT product_id, category, count(DISTINCT order_id) AS order_count,
 {money(_SUM_R)} AS total_revenue, {money(_SUM_P)} AS total_profit, {_MARGIN} AS profit_margin_pct,
 CASE WHEN {_SUM_P} * 100 < 10 * {_SUM_R} THEN 'LOW MARGIN'
  WHEN {_SUM_P} * 100 < 20 * {_SUM_R} THEN 'MEDIUM MARGIN' ELSE 'HEALTHY MARGIN' END
  AS margin_status
 FROM sales GROUP BY product_id, category HAVING {_SUM_R} > 10000
 ORDER BY {_SUM_R} DESC, profit_margin_pct, product_id LIMIT 20"""

_CHURN = f"""SELECT *, CASE WHEN churn_rate_pct > 70 THEN 'HIGH CHURN'
 WHEN churn_rate_pct > 50 THEN 'MODERATE CHURN' ELSE 'LOW CHURN' END AS churn_status
 FROM (SELECT segment, count(*) AS customer_count,
  {half_up('sum(total_orders)', 'count(*)')} AS avg_orders_per_customer,
  {half_up('sum(days_active)', 'count(*)', 0)} AS avg_days_active,
  count(*) FILTER (WHERE total_orders = 1) AS one_time_customers,
  {pct('count(*) FILTER (WHERE total_orders = 1)', 'count(*)')} AS churn_rate_pct
  FROM ({_ACTIVITY}) GROUP BY segment)"""

_RECOMMENDATION = """SELECT category, order_count, total_revenue, total_profit, profit_margin_pct,
 avg_order_value, CASE WHEN profit_margin_pct < 10 AND revenue_percentile > 0.7
  THEN 'DISCONTINUE - Low margin, low revenue'
  WHEN profit_margin_pct < 15 THEN 'REVIEW - Low margin'
  WHEN revenue_percentile > 0.8 THEN 'REVIEW - Low revenue' ELSE 'KEEP' END AS recommendation
 FROM ranked"""

_MIX = f"""SELECT category, count(DISTINCT product_id) AS product_count,
 count(DISTINCT order_id) AS order_count, {money(_SUM_R)} AS total_revenue,
 {pct('count(DISTINCT order_id)', '(SELECT count(DISTINCT order_id) FROM sales)')}
  AS order_share_pct,
 {pct(_SUM_R, '(SELECT sum(revenue_c) FROM sales)')} AS revenue_share_pct
 FROM sales GROUP BY category"""

_SUMMARY = """SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'high') AS high,
 count(*) FILTER (WHERE severity = 'medium') AS medium,
 count(*) FILTER (WHERE severity = 'low') AS low FROM insights"""

_CUSTOMER_RANK = f"""SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC, customer_id)
 AS INTEGER) AS position, substr(customer_id, 1, 12) || '…' AS short_id, segment, country,
 order_count, total_revenue, avg_order_value FROM ({_top_customers()})"""

_FAIL_TIER = "CASE WHEN failure_rate_pct > 10 THEN 'danger' WHEN failure_rate_pct > 5 THEN 'warning'"

ORACLE: dict[str, str] = {
    "items_with_orders": _plain(
        f"""SELECT i.order_id, order_item_id, product_id, {money('price_c')} AS price, customer_id,
 ts AS order_purchase_timestamp, order_status
 FROM raw_items i LEFT JOIN raw_orders o ON o.order_id = i.order_id"""
    ),
    "payments_by_order": _plain(
        f"SELECT order_id, payment_type, {money('value_c')} AS payment_value FROM payments"
    ),
    "order_items_dedup": _plain(
        f"SELECT order_id, order_item_id, product_id, {money('price_c')} AS price FROM items"
    ),
    "channel_map": _plain(f"SELECT order_id, payment_type, {_CHANNEL} AS channel FROM payments"),
    "order_headers": _graded("SELECT * FROM headers"),
    "fact_orders_build": _plain(_CLEAN_FACT),
    "fact_orders_build_graded": _graded(_CLEAN_FACT),
    "customer_signup": _plain(
        """SELECT customer_id, CAST(min(ts) AS DATE) AS signup_date, count(*) AS order_count
 FROM raw_orders GROUP BY customer_id"""
    ),
    "customer_segment_assign": _graded(
        """SELECT customer_id, count(*) AS order_count, CASE WHEN count(*) <= 1 THEN 'New'
 WHEN count(*) <= 5 THEN 'Returning' ELSE 'VIP' END AS segment
 FROM raw_orders GROUP BY customer_id"""
    ),
    "surrogate_keys": _graded("SELECT customer_key, customer_id FROM dim_customer"),
    "dim_customer_build": _plain("SELECT * FROM dim_customer"),
    "dim_customer_build_graded": _graded("SELECT * FROM dim_customer"),
    "category_translate": _plain("SELECT * FROM categories"),
    "product_price_stats": _plain(
        f"SELECT product_id, price_count, {money('unit_price_c')} AS unit_price FROM prices"
    ),
    "dim_product_build": _plain(_DIM_PRODUCT),
    "dim_date_build": _plain("SELECT * FROM dim_date"),
    "star_build": _graded(_KEYED_FACT),
    "etl_audit": _plain(_audit("SELECT count(*) FROM raw_customers")),
    "etl_audit_graded": _graded(
        _audit("SELECT count(*) FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
    ),
    "dim_profile": _graded(_PROFILE),
    "clean_csv_round_trip": _plain(_CSV_FACT),
    "fact_key_lookup": _plain(_KEYED_FACT),
    "warehouse_load": _graded(_KEYED_FACT),
    "dimension_lookup": _graded("SELECT customer_key, customer_id FROM dim_customer"),
    "sql_category_status": _graded(
        f"""SELECT category, payment_status, count(*) AS items, {money(_SUM_R)} AS revenue
 FROM wide GROUP BY category, payment_status"""
    ),
    "warehouse_row_counts": _plain(_ROW_COUNTS),
    "orphan_counts": _plain(_ORPHANS),
    "dq_not_null": _plain(_NULLS),
    "dq_unique": _plain(_DUPLICATES),
    "dq_domain": _plain(_DOMAINS),
    "warehouse_validation": _graded(_VALIDATION),
    "broken_orphan_counts": _broken(_ORPHANS),
    "broken_not_null": _broken(_NULLS),
    "broken_unique": _broken(_DUPLICATES),
    "broken_domain": _broken(_DOMAINS),
    "broken_validation": _broken(_VALIDATION),
    # Copies with nulls change nothing: the SQL reads the tables without them.
    "dedup_null_copies": _plain(_CLEAN_FACT),
    "dedup_null_copies_customer": _plain("SELECT * FROM dim_customer"),
    "dedup_null_copies_product": _plain("SELECT * FROM categories"),
    # Repeated items keep the first by product id, which is text here.
    "raw_csv_build": _plain(_CSV_FACT).replace(
        "ORDER BY product_id, price_c", "ORDER BY CAST(product_id AS VARCHAR), price_c"
    ),
    "raw_csv_rejects": """
 SELECT 'orders' AS table_name, 'order_purchase_timestamp is no timestamp_ntz' AS reason,
  count(*) AS n_rows FROM orders WHERE o_orderkey % 11 = 0 HAVING count(*) > 0
 UNION ALL SELECT 'order_items', 'price is no decimal(18,2)', count(*) FROM lineitem
  WHERE l_orderkey % 5 = 0 AND l_linenumber = 1 HAVING count(*) > 0
 UNION ALL SELECT 'order_items', 'number of fields', count(*) FROM lineitem
  WHERE l_orderkey % 7 = 0 AND l_linenumber = 2 HAVING count(*) > 0
 UNION ALL SELECT 'customers', 'number of fields', count(*) FROM customer
  WHERE c_custkey % 3 = 0 HAVING count(*) > 0""",
    "raw_csv_kept_customers": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
 'the "' || c_mktsegment || '", or so' AS customer_city FROM customer WHERE c_custkey % 3 <> 0""",
    "raw_csv_kept_fact": _plain(_CSV_FACT)
    .replace("ORDER BY product_id, price_c", "ORDER BY CAST(product_id AS VARCHAR), price_c")
    .replace("FROM orders)", "FROM orders WHERE o_orderkey % 11 <> 0)", 1)
    .replace(
        "FROM lineitem)",
        "FROM lineitem WHERE NOT (l_orderkey % 5 = 0 AND l_linenumber = 1)"
        " AND NOT (l_orderkey % 7 = 0 AND l_linenumber = 2))", 1,
    ),
    "raw_csv_dim_customer": _plain(_CSV_CUSTOMER),
    "raw_csv_dim_product": _plain(_CSV_PRODUCT),
    "clean_csv_dim_customer": _plain(_CSV_CUSTOMER_KEYS),
    "clean_csv_dim_product": _plain(_CSV_PRODUCT_KEYS),
    "clean_csv_dim_date": _plain("SELECT * FROM dim_date"),
    "warehouse_dim_customer": _graded("SELECT * FROM dim_customer"),
    "warehouse_dim_product": _graded(_DIM_PRODUCT),
    "warehouse_dim_date": _graded("SELECT * FROM dim_date"),
    "payload_customers": _graded(_top_customers()),
    "payload_channels": _graded(
        f"""SELECT channel, total_orders, successful_orders, revenue,
 failure_rate_pct AS failure_rate FROM ({_CHANNEL_REPORT})"""
    ),
    "payload_insights": _graded(
        "SELECT type, category, title, message, severity FROM insights", _all_rules()
    ),
    "kpi_revenue": _graded(
        f"""SELECT {money(_SUM_R)} AS total_revenue, {money(_SUM_P)} AS total_profit,
 {_MARGIN} AS profit_margin_pct FROM sales"""
    ),
    "kpi_success_rate": _graded(
        f"""SELECT count(*) AS total_orders, {_PAID} AS successful_orders,
 {pct(_PAID, 'count(*)')} AS success_rate_pct FROM wide"""
    ),
    "kpi_retention": _retention(cross_year=False),
    "kpi_retention_cross_year": _retention(cross_year=True),
    "bitmap_retention": _retention(cross_year=False),
    "bitmap_retention_cross_year": _retention(cross_year=True),
    "bitmap_customers_by_month": _graded(
        """SELECT year, month, count(DISTINCT customer_key) AS customers FROM sales
 GROUP BY year, month"""
    ),
    "bitmap_customers_by_channel": _graded(
        "SELECT channel, count(DISTINCT customer_key) AS customers FROM sales GROUP BY channel"
    ),
    "sketched_orders_by_category": _graded(
        """SELECT category, count(DISTINCT order_id) AS orders, true AS within_bound
 FROM sales GROUP BY category"""
    ),
    "kpi_failed_by_channel": _graded(_FAILED_BY_CHANNEL),
    "kpi_order_value": _graded(_ORDER_VALUE),
    "kpi_revenue_per_customer": _graded(_REVENUE_PER_CUSTOMER),
    "kpi_revenue_by_category": _graded(_category_report(10)),
    "kpi_monthly_trend": _plain(_monthly()),
    "kpi_channel_monthly": _graded(
        f"""SELECT year, month, channel, count(*) AS order_count, {money(_SUM_R)} AS revenue,
 {pct(_FAILED, 'count(*)')} AS failed_pct FROM wide GROUP BY year, month, channel"""
    ),
    "aq_product_margin": _graded(_PRODUCT_MARGIN),
    "aq_customer_activity": _graded(_ACTIVITY),
    "aq_segment_churn": _graded(_CHURN),
    "aq_channel_failure": _graded(_CHANNEL_FAILURE),
    "aq_category_ranking": _graded("SELECT * FROM ranked", _RANKED),
    "aq_product_ranking": _graded(
        f"""SELECT product_id, category, {money('revenue_c')} AS total_revenue, profit_margin_pct,
 percent_rank() OVER (ORDER BY revenue_c DESC) AS revenue_percentile,
 percent_rank() OVER (ORDER BY profit_margin_pct DESC) AS margin_percentile
 FROM (SELECT product_id, category, {_SUM_R} AS revenue_c, {pct(_SUM_P, _SUM_R)} AS profit_margin_pct
  FROM sales GROUP BY product_key, product_id, category)"""
    ),
    "aq_ranked_customers": _graded(
        f"""SELECT customer_id, {money('revenue_c')} AS total_revenue, place
 FROM (SELECT customer_id, {_SUM_R} AS revenue_c, count(*) OVER () AS n,
   row_number() OVER (ORDER BY {_SUM_R} DESC, customer_id) AS place
  FROM sales GROUP BY customer_key, customer_id) WHERE place <= n // 2"""
    ),
    "aq_category_recommendation": _graded(_RECOMMENDATION, _RANKED),
    "aq_top_customers": _graded(_top_customers(f"{money(_SUM_P)} AS total_profit,")),
    "aq_category_mix": _graded(_MIX),
    "api_executive_kpis": _graded(_EXECUTIVE),
    "api_aov": _graded(f"SELECT avg_order_value FROM ({_ORDER_VALUE})"),
    "api_revenue_per_customer": _graded(
        f"SELECT segment, revenue_per_customer FROM ({_REVENUE_PER_CUSTOMER})"
    ),
    "api_failed_payments": _graded(
        f"SELECT channel, failed_payment_pct FROM ({_FAILED_BY_CHANNEL})"
    ),
    "api_monthly_trends": _graded(_monthly(_YEAR_MONTH)),
    "api_category_performance": _graded(_category_report(15)),
    "api_customer_segments": _graded(_SEGMENT_REPORT),
    "api_channel_performance": _graded(_CHANNEL_REPORT),
    "api_top_customers": _graded(_top_customers()),
    "insight_low_margin": _graded(_rule_low_margin()),
    "insight_failed_payments": _graded(_rule_failed()),
    "insight_retention": _graded(_rule_retention(30)),
    "insight_category_review": _graded(_rule_review()),
    "insight_top_category": _graded(_rule_top()),
    "insights_all": _graded("SELECT * FROM insights", _all_rules()),
    "insights_summary": _graded(_SUMMARY, _all_rules()),
    "summaries_daily": _graded(
        f"""SELECT order_date_key, channel, payment_status, count(DISTINCT order_id) AS orders,
 {_ITEM_SUMS} FROM fact_orders GROUP BY order_date_key, channel, payment_status"""
    ),
    "summaries_customers": _graded(
        f"""SELECT customer_key, count(DISTINCT order_id) AS orders, {_ITEM_SUMS}
 FROM sales GROUP BY customer_key"""
    ),
    "summaries_products": _graded(
        f"""SELECT product_key, product_id, category, {_ITEM_SUMS}
 FROM sales GROUP BY product_key, product_id, category"""
    ),
    "dashboard_payload": _payload(),
    "payload_round_trip": _graded(
        f"""SELECT year_month, total_revenue AS revenue, total_profit AS profit,
 order_count AS orders FROM ({_monthly(_YEAR_MONTH)})"""
    ),
    "dash_low_margin": _graded(
        f"""SELECT category, total_revenue, profit_margin_pct,
 CASE WHEN profit_margin_pct < 5 THEN 'danger' ELSE 'warning' END AS severity
 FROM ({_category_report(15)}) WHERE profit_margin_pct < 10"""
    ),
    "dash_top_categories": _graded(_category_report(10)),
    "dash_category_bubble": _graded(
        f"""SELECT category, total_revenue, total_profit, profit_margin_pct,
 sqrt(order_count) * CAST(1.5 AS DOUBLE) + CAST(8 AS DOUBLE) AS bubble_size
 FROM ({_category_report(15)})"""
    ),
    "dash_ops_alerts": _graded(
        f"""SELECT channel, failure_rate_pct FROM ({_CHANNEL_REPORT}) WHERE failure_rate_pct > 5"""
    ),
    "dash_channel_tier": _graded(
        f"SELECT *, {_FAIL_TIER} ELSE 'ok' END AS tier FROM ({_CHANNEL_REPORT})"
    ),
    "dash_segment_share": _graded(
        f"""SELECT segment, count(*) AS customer_count,
 {pct('count(*)', '(SELECT count(*) FROM dim_customer)')} AS customer_share_pct
 FROM dim_customer GROUP BY segment"""
    ),
    "dash_customer_rank": _graded(_CUSTOMER_RANK),
    "dash_insight_feed": _graded(
        """SELECT *, (SELECT count(*) FROM insights) AS insight_count FROM insights
 ORDER BY rule_order, rank LIMIT 6""",
        _all_rules(),
    ),
}
