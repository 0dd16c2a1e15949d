"""Expected results of the queries as SQL for DuckDB, written from the definitions.

The SQL reads the same test tables and shares no code with the Spark side: dates
are taken from the tables instead of being parsed, natural keys stand for hashes.
"""

from __future__ import annotations

_STATES = "['TX', 'CA', 'NY', 'FL', 'OH']"


def _rendered(ts: str, n: str) -> str:
    """A timestamp written in layout number n % 11."""
    layouts = [
        "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y", "%m/%d/%Y %H:%M:%S", "%m-%d-%Y",
        "%m-%d-%Y %H:%M:%S", "%-m/%-d/%Y", "%Y/%m/%d", "%d-%m-%Y %H:%M", "%d-%m-%Y", "%Y-%m-%d",
    ]
    cases = " ".join(f"WHEN {i} THEN strftime({ts}, '{p}')" for i, p in enumerate(layouts))
    return f"CASE {n} % 11 {cases} END"


def _read_back(ts: str, n: str) -> str:
    """What parsing the rendered text yields: month and day swap in layout 9 up to day 12."""
    return (
        f"CASE WHEN {n} % 11 IN (0, 1, 3, 5) THEN date_trunc('second', {ts}) "
        f"WHEN {n} % 11 = 8 THEN date_trunc('minute', {ts}) "
        f"WHEN {n} % 11 = 9 AND day({ts}) <= 12 "
        f"THEN CAST(make_date(year({ts}), day({ts}), month({ts})) AS TIMESTAMP) "
        f"ELSE CAST(date_trunc('day', {ts}) AS TIMESTAMP) END"
    )


def _first(keys: str, order: str, source: str, where: str = "true") -> str:
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) rn "
        f"FROM {source}) WHERE rn = 1 AND ({where})"
    )


_CUSTOMERS = f"""
person AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 499 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
    c_name AS customer_name,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN c_name
         WHEN c_custkey % 23 = 0 THEN 'c' || c_custkey || '@mail'
         ELSE 'c' || c_custkey || '@shop' || c_nationkey || '.example' END AS email,
    c_nationkey
  FROM customer),
signup AS (
  SELECT *, CAST(DATE '1994-01-01' + CAST(c_custkey % 300 AS INTEGER) AS TIMESTAMP) AS ts FROM person),
log_customers AS (
  SELECT customer_id, customer_name, email, 'Port Nation_' || c_nationkey AS city,
    {_STATES}[c_nationkey % 5 + 1] AS state,
    CASE WHEN c_custkey % 211 = 0 THEN 'n/a' ELSE {_rendered('ts', 'c_custkey')} END AS signup_date,
    CASE WHEN c_custkey % 211 <> 0 THEN {_read_back('ts', 'c_custkey')} END AS signup_ts
  FROM signup
  UNION ALL
  SELECT customer_id, customer_name, email, 'New Town_' || (o_orderkey % 50),
    {_STATES}[o_orderkey % 5 + 1],
    {_rendered('o_orderdate', 'o_orderkey')}, {_read_back('o_orderdate', 'o_orderkey')}
  FROM orders JOIN person ON o_custkey = c_custkey),
clean_customers AS ({_first('customer_id, signup_ts', 'customer_name, email, city, state, signup_date', 'log_customers')}),
slv_customers AS (SELECT * FROM clean_customers WHERE customer_id IS NOT NULL),
dim_customer AS (
  SELECT *, signup_ts AS start_at,
    lead(signup_ts) OVER (PARTITION BY customer_id ORDER BY signup_ts) AS end_at
  FROM slv_customers WHERE signup_ts IS NOT NULL),
dim_customer_keyed AS (
  SELECT customer_id, customer_name, email, city, state, signup_ts, start_at AS valid_from,
    end_at AS valid_to, end_at IS NULL AS is_current FROM dim_customer)"""

_PRODUCTS = f"""
log_products AS (
  SELECT CASE WHEN p_partkey % 1999 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
    lower(p_type) AS product_category, p_name AS product_name,
    CASE WHEN p_partkey % 29 = 0 THEN -p_retailprice WHEN p_partkey % 31 = 0 THEN 0.0
         WHEN p_partkey % 37 = 0 THEN NULL ELSE p_retailprice END AS base_price,
    CASE WHEN p_partkey % 19 <> 0 THEN p_size * 10 END AS weight_grams
  FROM part, generate_series(1, CASE WHEN p_partkey % 40 = 0 THEN 2 ELSE 1 END)),
clean_products AS ({_first('product_id', 'product_category, product_name, base_price, weight_grams', 'log_products')}),
slv_products AS (SELECT * FROM clean_products WHERE product_id IS NOT NULL AND base_price > 0),
dim_product AS (
  SELECT product_id, product_category, product_name, base_price, weight_grams, false AS is_unknown_member
  FROM slv_products
  UNION ALL SELECT 'UNKNOWN', 'unknown', 'Unknown Product', NULL, NULL, true)"""

_SELLERS = f"""
log_sellers AS (
  SELECT CASE WHEN s_suppkey % 91 <> 0 THEN CAST(s_suppkey AS VARCHAR) END AS seller_id,
    CASE WHEN s_suppkey % 13 <> 0 THEN s_name END AS seller_name,
    'Old ' || upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS seller_city,
    {_STATES}[s_nationkey % 5 + 1] AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey,
    generate_series(1, CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END)),
clean_sellers AS ({_first('seller_id', 'seller_name, seller_city, seller_state', 'log_sellers')}),
slv_sellers AS (SELECT * FROM clean_sellers WHERE seller_id IS NOT NULL)"""

_ORDERS = f"""
log_orders AS (
  SELECT CASE WHEN o_orderkey % 997 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderkey % 101 = 0 THEN 'On Hold' WHEN o_orderstatus = 'P' THEN ' Shipped'
         WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'PLACED '
         WHEN o_orderstatus = 'O' THEN ' paid '
         WHEN o_orderkey % 5 = 0 THEN 'Returned' WHEN o_orderkey % 5 = 1 THEN 'CANCELED'
         ELSE ' Delivered' END AS raw_status,
    CASE WHEN o_orderkey % 103 = 0 THEN 'soon' WHEN o_orderkey % 107 = 0 THEN NULL
         ELSE {_rendered('o_orderdate', 'o_orderkey')} END AS order_date,
    CASE WHEN o_orderkey % 103 <> 0 AND o_orderkey % 107 <> 0
         THEN {_read_back('o_orderdate', 'o_orderkey')} END AS order_ts,
    CASE WHEN o_orderkey % 109 = 0 THEN -o_totalprice WHEN o_orderkey % 113 = 0 THEN NULL
         ELSE o_totalprice END AS order_total
  FROM orders, generate_series(1, CASE WHEN o_orderkey % 50 = 0 THEN 2 ELSE 1 END)),
first_orders AS ({_first('order_id', 'customer_id, raw_status, order_date, order_total', 'log_orders')}),
clean_orders AS (
  SELECT order_id, customer_id, lower(trim(raw_status)) AS order_status, order_date, order_ts, order_total
  FROM first_orders),
slv_orders AS (SELECT * FROM clean_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL)"""

_ITEMS = f"""
log_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CASE WHEN l_partkey % 499 <> 0 THEN l_linenumber END AS item_seq,
    CASE WHEN (l_suppkey * 7 + l_linenumber) % 89 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS product_id,
    CASE WHEN l_partkey % 307 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS seller_id,
    CASE WHEN l_partkey % 211 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    CAST(CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE
      CAST(CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS DECIMAL(12,2))
      * CASE WHEN l_partkey % 223 = 0 THEN -1 ELSE 1 END END AS DECIMAL(18,2)) AS unit_price
  FROM lineitem),
clean_order_items AS ({_first('order_id, item_seq', 'product_id, seller_id, quantity, unit_price', 'log_items')}),
slv_order_items AS (
  SELECT * FROM clean_order_items WHERE order_id IS NOT NULL AND item_seq IS NOT NULL
    AND product_id IS NOT NULL AND seller_id IS NOT NULL AND quantity > 0)"""

_PAYMENTS = """
log_payments AS (
  SELECT CASE WHEN o_orderkey % 997 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
    ['credit_card', 'debit_card', 'voucher', 'boleto', 'gift_card'][o_orderkey % 5 + 1] AS payment_type,
    CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_orderkey % 4 END AS n,
    CASE WHEN o_orderkey % 61 = 0 THEN -o_totalprice ELSE o_totalprice END AS total
  FROM orders),
clean_payments AS (
  SELECT order_id, payment_type, CAST(i AS BIGINT) AS installment_no, total / n AS amount, i <= 2 AS paid
  FROM log_payments, generate_series(1, n) AS g(i)),
slv_payments AS (SELECT * FROM clean_payments WHERE order_id IS NOT NULL)"""

_REVIEWS = f"""
clean_reviews AS (
  SELECT CASE WHEN event_id % 401 <> 0 THEN CAST(event_id AS VARCHAR) END AS review_id,
    CASE WHEN event_id % 397 <> 0 THEN CAST(user_id AS VARCHAR) END AS order_id,
    CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS BIGINT) AS score,
    CASE WHEN event_type <> 'error' THEN event_type END AS comment,
    {_rendered('ts', 'event_id')} AS review_date,
    {_read_back('ts', 'event_id')} AS review_ts,
    CASE WHEN event_id % 50 <> 0 THEN event_type = 'purchase' END AS verified,
    CASE WHEN event_id % 50 <> 0 THEN CAST(floor(value) AS BIGINT) END AS helpful_votes
  FROM events),
slv_reviews AS (
  SELECT * FROM clean_reviews
  WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND score BETWEEN 1 AND 5)"""

_DATES = """
days AS (
  SELECT CAST(d AS DATE) AS full_date
  FROM generate_series({first}, {last}, INTERVAL 1 DAY) AS g(d)),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_sk, full_date,
    CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
    CAST(day(full_date) AS INTEGER) AS day_of_month, dayname(full_date) AS day_name,
    CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
    dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM days)"""
_WIDE_DATES = _DATES.format(first="DATE '1994-01-01'", last="DATE '2003-12-31'")

_FACT_PARTS = (_CUSTOMERS, _PRODUCTS, _SELLERS, _ORDERS, _ITEMS, _WIDE_DATES)


def _fact_sql(customer: str) -> str:
    return f"""
fct AS (
  SELECT i.order_id, i.item_seq, c.customer_id, c.valid_from, c.state,
    coalesce(p.product_id, 'UNKNOWN') AS product_id, coalesce(p.product_category, 'unknown') AS product_category,
    s.seller_id, d.date_sk, i.quantity,
    CASE WHEN i.unit_price > 0 THEN i.unit_price END AS unit_price,
    CASE WHEN i.unit_price > 0 THEN round(i.quantity * i.unit_price, 2) END AS revenue,
    o.order_status
  FROM slv_order_items i JOIN slv_orders o ON i.order_id = o.order_id
  LEFT JOIN dim_customer_keyed c ON o.customer_id = c.customer_id AND {customer}
  LEFT JOIN slv_products p ON i.product_id = p.product_id
  LEFT JOIN slv_sellers s ON i.seller_id = s.seller_id
  LEFT JOIN dim_date d ON CAST(strftime(o.order_ts, '%Y%m%d') AS INTEGER) = d.date_sk)"""


_FACT = (*_FACT_PARTS, _fact_sql("c.is_current"))
_EVENT_FACT = (*_FACT_PARTS, _fact_sql(
    "c.valid_from <= o.order_ts AND (o.order_ts < c.valid_to OR c.valid_to IS NULL)"
))


def _mean(total: str, count: str, digits: int) -> str:
    """Mean of exact amounts, rounded half up on a decimal."""
    return (
        f"CAST(round(CAST(CAST({total} AS DOUBLE) / nullif({count}, 0) AS DECIMAL(24,8)), {digits}) AS DOUBLE)"
    )


def _share(part: str, total: str, digits: int = 4) -> str:
    return (
        f"CAST(round(CAST(100 * CAST({part} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0) "
        f"AS DECIMAL(24,8)), {digits}) AS DOUBLE)"
    )


_DAILY = f"""
mv_daily AS (
  SELECT full_date, year, quarter, month, month_name, is_weekend,
    count(DISTINCT order_id) AS order_count, count(*) AS line_item_count,
    CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
    {_mean('sum(revenue)', 'count(revenue)', 2)} AS avg_line_revenue
  FROM fct JOIN dim_date ON fct.date_sk = dim_date.date_sk
  GROUP BY full_date, year, quarter, month, month_name, is_weekend)"""
_CATEGORY = f"""
mv_category AS (
  SELECT product_category, count(DISTINCT order_id) AS order_count,
    count(DISTINCT product_id) AS distinct_products, CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(revenue) AS DOUBLE) AS total_revenue,
    {_mean('sum(unit_price)', 'count(unit_price)', 2)} AS avg_unit_price
  FROM fct GROUP BY product_category)"""
_STATE = f"""
mv_state AS (
  SELECT state, count(DISTINCT customer_id) AS customer_count, count(DISTINCT order_id) AS order_count,
    CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
    {_mean('sum(revenue)', 'count(DISTINCT order_id)', 2)} AS avg_order_value
  FROM fct WHERE customer_id IS NOT NULL GROUP BY state)"""
_FUNNEL = f"""
mv_funnel AS (
  SELECT o.order_status, count(DISTINCT o.order_id) AS order_count,
    CAST(sum(f.revenue) AS DOUBLE) AS total_revenue,
    {_mean('sum(f.revenue)', 'count(f.revenue)', 2)} AS avg_line_revenue
  FROM slv_orders o LEFT JOIN fct f ON o.order_id = f.order_id GROUP BY o.order_status)"""
_SUMMARY = f"""
mv_reviews AS (
  SELECT score, count(*) AS review_count, {_share('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct_of_reviews,
    CAST(sum(CASE WHEN verified THEN 1 ELSE 0 END) AS BIGINT) AS verified_count,
    {_mean('sum(helpful_votes)', 'count(helpful_votes)', 1)} AS avg_helpful_votes,
    count(comment) AS reviews_with_comment
  FROM slv_reviews GROUP BY score)"""


def _sql(parts: tuple[str, ...] | str, select: str) -> str:
    parts = (parts,) if isinstance(parts, str) else parts
    return "WITH " + ",".join(parts) + "\n" + select


_RULE_SQL = {
    "customers": (_CUSTOMERS, [
        ("valid_customer_id", "drop", "customer_id IS NULL"),
        ("valid_email_format", "warn", "email IS NOT NULL AND NOT regexp_full_match(email, '[^@]+@[^@]+[.][^@]+')"),
        ("parseable_signup_date", "warn", "signup_date IS NOT NULL AND signup_ts IS NULL")]),
    "products": (_PRODUCTS, [
        ("valid_product_id", "drop", "product_id IS NULL"),
        ("positive_price", "drop", "base_price IS NULL OR base_price <= 0"),
        ("weight_present", "warn", "weight_grams IS NULL")]),
    "sellers": (_SELLERS, [
        ("valid_seller_id", "drop", "seller_id IS NULL"),
        ("seller_name_present", "warn", "seller_name IS NULL")]),
    "orders": (_ORDERS, [
        ("valid_order_id", "drop", "order_id IS NULL"),
        ("has_customer", "drop", "customer_id IS NULL"),
        ("known_status", "warn",
         "order_status NOT IN ('placed', 'paid', 'shipped', 'delivered', 'canceled', 'returned')"),
        ("non_negative_total", "warn", "order_total < 0"),
        ("parseable_order_date", "warn", "order_date IS NOT NULL AND order_ts IS NULL")]),
    "order_items": (_ITEMS, [
        ("valid_order_ref", "drop", "order_id IS NULL"),
        ("valid_item_seq", "drop", "item_seq IS NULL"),
        ("has_product", "drop", "product_id IS NULL"),
        ("has_seller", "drop", "seller_id IS NULL"),
        ("positive_quantity", "drop", "quantity IS NULL OR quantity <= 0"),
        ("unit_price_present", "warn", "unit_price IS NULL")]),
    "payments": (_PAYMENTS, [
        ("valid_order_ref", "drop", "order_id IS NULL"),
        ("non_negative_amount", "warn", "amount < 0"),
        ("known_payment_type", "warn",
         "payment_type NOT IN ('credit_card', 'debit_card', 'voucher', 'boleto')")]),
    "reviews": (_REVIEWS, [
        ("valid_review_id", "drop", "review_id IS NULL"),
        ("valid_order_ref", "drop", "order_id IS NULL"),
        ("valid_score", "drop", "score IS NULL OR score < 1 OR score > 5"),
        ("parseable_review_date", "warn", "review_date IS NOT NULL AND review_ts IS NULL")]),
}


def _metrics_sql(entity: str) -> str:
    parts, rules = _RULE_SQL[entity]
    rows = " UNION ALL ".join(
        f"SELECT 'slv_{entity}' AS table_name, '{rule}' AS rule, '{action}' AS action, "
        f"count(*) AS rows_checked, count(*) - count(*) FILTER (WHERE {broken}) AS rows_passed, "
        f"count(*) FILTER (WHERE {broken}) AS rows_failed, "
        + (f"count(*) FILTER (WHERE {broken})" if action == "drop" else "CAST(0 AS BIGINT)")
        + f" AS rows_dropped FROM clean_{entity}"
        for rule, action, broken in rules
    )
    return _sql(parts, rows)


_RAW_ORDER_DROPS = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, "
    "o_orderstatus AS order_status, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
    "o_totalprice AS order_total"
)

_CHANGES = """
changes AS (
  SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority
  FROM orders GROUP BY o_custkey, o_orderdate),
versions AS (
  SELECT *, o_orderdate AS start_at,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
  FROM changes)"""


def _unresolved(key: str, missing: str) -> str:
    return (
        f"SELECT '{key}' AS dimension_key, count(*) AS total_rows, "
        f"count(*) - count(*) FILTER (WHERE {missing}) AS resolved_rows, "
        f"count(*) FILTER (WHERE {missing}) AS unresolved_rows FROM fct"
    )


def _email(groups_see: bool) -> str:
    return "email" if groups_see else "left(email, 2) || '***@***.***'"


def oracle_sql() -> dict[str, str]:
    sql = {
        "ingest_csv": _sql(_ITEMS, "SELECT order_id, item_seq, product_id, seller_id, quantity, "
                                   "CAST(unit_price AS DOUBLE) AS unit_price FROM log_items"),
        "ingest_json": _sql(_PAYMENTS, """
            SELECT order_id, payment_type, CAST(n AS INTEGER) AS installment_count,
              CASE WHEN n >= 0 THEN array_to_string(list_transform(generate_series(1, n),
                lambda i: i || ':' || (i <= 2)), ',') END AS numbers_and_states,
              CASE WHEN n > 0 THEN round(total / n * n, 2) WHEN n = 0 THEN 0 END AS amount_sum,
              CASE WHEN n > 0 THEN total / n END AS first_amount,
              CASE WHEN n > 0 THEN true END AS first_paid FROM log_payments"""),
        "ingest_rescued": """
            SELECT CAST(p_partkey AS VARCHAR) AS product_id,
              CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_size AS DOUBLE) END AS base_price, p_size AS weight_grams,
              CASE WHEN p_partkey % 10 = 0 OR p_partkey % 15 = 0 THEN concat_ws(',', p_partkey, p_type, p_name,
                CASE WHEN p_partkey % 10 = 0 THEN '12.50 USD' ELSE CAST(p_size AS VARCHAR) END, p_size,
                CASE WHEN p_partkey % 15 = 0 THEN 'EXTRA' END) END AS _rescued_data
            FROM part""",
        "ingest_fixed_schema": _sql(_REVIEWS, """
            SELECT review_id, order_id, score, '  ' || comment || ' ' AS comment, review_date,
              verified, helpful_votes FROM clean_reviews"""),
        "with_ingest_metadata": "SELECT c_custkey, true AS has_file, true AS has_file_time, "
                                "true AS ingested_after_file FROM customer",
        "infer_landing_schema": """
            SELECT column_name, CASE WHEN column_type = 'BIGINT' AND column_name IN ('o_orderkey', 'o_custkey')
                THEN 'int' WHEN column_type = 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type
            FROM (DESCRIBE orders)""",
        "evolve_schema_add_columns": _RAW_ORDER_DROPS + """,
            CASE WHEN o_orderdate >= DATE '1997-01-01' THEN o_orderpriority END AS priority FROM orders""",
        "incremental_refresh": _RAW_ORDER_DROPS + " FROM orders",
        "full_refresh": "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, "
                        "lower(o_orderstatus) AS order_status, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
                        "CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS order_ts, "
                        "o_totalprice AS order_total FROM orders",
        "append_only_guard": _sql(_SELLERS, "SELECT true AS refused, count(*) AS row_count FROM slv_sellers"),
        "guard_rewritten_file": _sql(_SELLERS, "SELECT true AS refused, count(*) AS row_count FROM slv_sellers"),
        "stream_table_scan": "SELECT * FROM events",
        "batch_table_scan": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
        "literal_row_union": _sql(_PRODUCTS, """
            SELECT product_category, count(*) AS product_count FROM slv_products GROUP BY 1
            UNION ALL SELECT 'unknown', NULL"""),
        "calendar_generator": """
            SELECT CAST(d AS DATE) AS full_date
            FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders),
              generate_series(date_trunc('day', a), date_trunc('day', b), INTERVAL 1 DAY) AS g(d)""",
        "streaming_table_sink": _sql(_REVIEWS, "SELECT * FROM clean_reviews"),
        "materialized_view_sink": "SELECT p_partkey, p_retailprice * 2 AS p_retailprice FROM part",
        "environment_config": _sql(_SELLERS, """
            SELECT 'dev' AS environment, count(*) AS row_count FROM slv_sellers
            UNION ALL SELECT 'prod', count(*) FROM slv_sellers"""),
        "preview_limit": _sql(_CUSTOMERS, "SELECT customer_id, email FROM dim_customer_keyed "
                                          "ORDER BY customer_id, valid_from LIMIT 5"),
        "text_functions": _sql(_CUSTOMERS, """
            SELECT customer_name, email, city, state, lower(customer_name) AS lower_name,
              left(customer_name, 2) || '..' AS initials,
              coalesce(regexp_full_match(email, '[^@]+@[^@]+[.][^@]+'), false) AS email_ok FROM log_customers"""),
        "messy_dates": f"""
            SELECT o_orderkey, {_rendered('o_orderdate', 'o_orderkey')} AS raw_date, parsed,
              CAST(strftime(parsed, '%Y%m%d') AS INTEGER) AS day_key
            FROM (SELECT *, {_read_back('o_orderdate', 'o_orderkey')} AS parsed FROM orders)""",
        "row_predicates": _sql(_ITEMS, """
            SELECT order_id, item_seq, quantity, CAST(unit_price AS DOUBLE) AS unit_price FROM log_items
            WHERE item_seq IS NOT NULL AND (quantity > 0 OR unit_price IS NULL)
              AND quantity BETWEEN 0 AND 40 AND item_seq IN (1, 2, 3, 4, 5)"""),
        "case_cast_coalesce": _sql(_PRODUCTS, """
            SELECT product_id, coalesce(weight_grams, -1) AS weight,
              CASE WHEN base_price > 0 THEN 'priced' END AS priced, base_price IS NULL AS no_price,
              CASE WHEN base_price > 0 THEN base_price END AS valid_price,
              base_price / weight_grams AS price_per_gram, TRY_CAST(product_id AS INTEGER) AS product_number
            FROM log_products"""),
        "price_guard": _sql(_ITEMS, """
            SELECT order_id, item_seq, CAST(CASE WHEN unit_price > 0 THEN unit_price END AS DOUBLE) AS unit_price,
              CAST(CASE WHEN unit_price > 0 THEN quantity * unit_price END AS DOUBLE) AS revenue
            FROM slv_order_items"""),
        "key_resolution_check": _sql(_FACT, " UNION ALL ".join([
            _unresolved("customer_sk", "customer_id IS NULL"),
            _unresolved("product_sk", "product_id = 'UNKNOWN'"),
            _unresolved("seller_sk", "seller_id IS NULL"),
            _unresolved("date_sk", "date_sk IS NULL"),
        ])),
        "unresolved_products": _sql((_PRODUCTS, _ITEMS), """
            SELECT product_id, count(*) AS row_count FROM slv_order_items
            WHERE product_id NOT IN (SELECT product_id FROM slv_products) GROUP BY product_id"""),
        "surrogate_key_unique": _sql(_CUSTOMERS, """
            SELECT count(*) AS row_count, count(DISTINCT (customer_id, valid_from)) AS business_keys,
              count(DISTINCT (customer_id, valid_from)) AS surrogate_keys FROM dim_customer_keyed"""),
        "inner_equi_join": _sql((_ORDERS, _ITEMS), """
            SELECT i.order_id, item_seq, order_status, quantity
            FROM slv_order_items i JOIN slv_orders o ON i.order_id = o.order_id"""),
        "left_equi_join": _sql((_ORDERS, _ITEMS), """
            SELECT o.order_id, order_status, line_count FROM slv_orders o
            LEFT JOIN (SELECT order_id, count(*) AS line_count FROM slv_order_items GROUP BY 1) i
            ON o.order_id = i.order_id"""),
        "left_join_current_version": _sql((_CUSTOMERS, _ORDERS), """
            SELECT o.order_id, o.customer_id, city, valid_from
            FROM slv_orders o LEFT JOIN dim_customer_keyed c ON o.customer_id = c.customer_id AND is_current"""),
        "left_join_on_expression": _sql((_ORDERS, _WIDE_DATES), """
            SELECT order_id, order_ts, full_date, day_name FROM slv_orders
            LEFT JOIN dim_date ON CAST(strftime(order_ts, '%Y%m%d') AS INTEGER) = date_sk"""),
        "unknown_member_join": _sql((_PRODUCTS, _ITEMS), """
            SELECT order_id, item_seq, coalesce(product_category, 'unknown') AS product_category,
              coalesce(product_name, 'Unknown Product') AS product_name
            FROM slv_order_items i LEFT JOIN slv_products p ON i.product_id = p.product_id"""),
        "point_in_time_join": _sql((_CUSTOMERS, _ORDERS), """
            SELECT o.order_id, o.customer_id, order_ts, city, state, valid_from
            FROM slv_orders o LEFT JOIN dim_customer_keyed c ON o.customer_id = c.customer_id
              AND valid_from <= order_ts AND (order_ts < valid_to OR valid_to IS NULL)"""),
        "explode_installments": _sql(_PAYMENTS, "SELECT * FROM clean_payments"),
        "struct_flatten_reviews": _sql(_REVIEWS, "SELECT review_id, score, verified, helpful_votes FROM clean_reviews"),
        "dedup_lineitem": _first(
            "l_orderkey, l_linenumber",
            "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
            "lineitem"),
        "dedup_distinct_keys": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
        "scd2_customer": _sql(_CHANGES, "SELECT * FROM versions"),
        "scd2_hot_keys": _sql(_CHANGES, "SELECT * FROM versions"),
        "scd2_out_of_order": _sql(_CHANGES, "SELECT * FROM versions"),
        "scd2_incremental": _sql(_CHANGES, "SELECT * FROM versions"),
        "scd2_tracked_columns": _sql(_CHANGES, """
            SELECT o_custkey, o_orderpriority, o_orderdate AS start_at,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
            FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before
                  FROM changes) WHERE before IS NULL OR before <> o_orderpriority"""),
        "scd2_current": _sql(_CHANGES, "SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority "
                                       "FROM versions WHERE end_at IS NULL"),
        "unsequenced_changes": _sql(_CUSTOMERS, "SELECT customer_id, customer_name, signup_date "
                                                "FROM clean_customers WHERE signup_ts IS NULL"),
        "scd1_dimension": """
            SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders) WHERE rn = 1""",
        "stream_static_equivalence": _sql((_REVIEWS, _SUMMARY), "SELECT * FROM mv_reviews"),
        "dim_date": _sql(_DATES.format(
            first="(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
            last="(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"), "SELECT * FROM dim_date"),
        "dim_product": _sql(_PRODUCTS, "SELECT * FROM dim_product"),
        "dim_seller": _sql(_SELLERS, "SELECT * FROM slv_sellers"),
        "dim_customer": _sql(_CUSTOMERS, "SELECT * FROM dim_customer"),
        "dim_customer_keyed": _sql(_CUSTOMERS, "SELECT true AS customer_sk, * FROM dim_customer_keyed"),
        "mv_revenue_daily": _sql((*_FACT, _DAILY), "SELECT * FROM mv_daily"),
        "medallion_run": _sql((*_FACT, _DAILY), "SELECT * FROM mv_daily"),
        "medallion_mv_sales_by_category": _sql((*_FACT, _CATEGORY), "SELECT * FROM mv_category"),
        "medallion_mv_sales_by_state": _sql((*_FACT, _STATE), "SELECT * FROM mv_state"),
        "medallion_mv_order_funnel": _sql((*_FACT, _FUNNEL), "SELECT * FROM mv_funnel"),
        "medallion_mv_review_summary": _sql((_REVIEWS, _SUMMARY), "SELECT * FROM mv_reviews"),
        "medallion_dim_date": _sql((_ORDERS, _DATES.format(
            first="(SELECT CAST(min(order_ts) AS DATE) FROM slv_orders)",
            last="(SELECT CAST(max(order_ts) AS DATE) FROM slv_orders)")), "SELECT * FROM dim_date"),
        "run_balance": _sql(_FACT, " UNION ALL ".join([*(
            f"SELECT '{entity}' AS entity, count(*) AS bronze_rows, CAST(0 AS BIGINT) AS rescued_rows, "
            f"CAST({arrived} AS BIGINT) AS arrived_rows, "
            + (f"count(*) - (SELECT count(*) FROM clean_{entity})" if entity not in ("payments", "reviews") else "CAST(0 AS BIGINT)")
            + f" AS duplicate_rows, (SELECT count(*) FROM clean_{entity}) - (SELECT count(*) FROM slv_{entity}) AS dropped_rows, "
            f"(SELECT count(*) FROM slv_{entity}) AS silver_rows, true AS adds_up FROM {source}"
            for entity, source, arrived in (
                ("customers", "log_customers", "count(*)"), ("products", "log_products", "count(*)"),
                ("sellers", "log_sellers", "count(*)"), ("orders", "log_orders", "count(*)"),
                ("order_items", "log_items", "count(*)"), ("payments", "log_payments", "sum(greatest(n, 0))"),
                ("reviews", "clean_reviews", "count(*)"))),
            "SELECT 'fct_sales', NULL, NULL, count(*), 0, count(*) - (SELECT count(*) FROM fct), "
            "(SELECT count(*) FROM fct), true FROM slv_order_items"])).replace(
                "WITH ", f"WITH {_PAYMENTS},{_REVIEWS},", 1),
        "run_unplaced": _sql(_FACT, """
            SELECT 'day' AS missing, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fct WHERE date_sk IS NULL
            UNION ALL SELECT 'product', count(*), CAST(sum(revenue) AS DOUBLE) FROM fct WHERE product_id = 'UNKNOWN'"""),
        "mart_incremental_daily": _sql((*_FACT, _DAILY), "SELECT * FROM mv_daily"),
        "mart_incremental_category": _sql((*_FACT, _CATEGORY), "SELECT * FROM mv_category"),
        "mart_incremental_state": _sql((*_FACT, _STATE), "SELECT * FROM mv_state"),
        "mart_incremental_funnel": _sql((*_FACT, _FUNNEL), "SELECT * FROM mv_funnel"),
        "mart_incremental_reviews": _sql((_REVIEWS, _SUMMARY), "SELECT * FROM mv_reviews"),
        "late_arriving_products": _sql((*_FACT_PARTS[:5],), """
            SELECT i.order_id, i.item_seq, i.product_id, coalesce(p.product_category, 'unknown') AS product_category
            FROM slv_order_items i JOIN slv_orders o ON i.order_id = o.order_id
            LEFT JOIN slv_products p ON i.product_id = p.product_id"""),
        "mv_sales_by_category": _sql((*_FACT, _CATEGORY), "SELECT * FROM mv_category"),
        "mv_sales_by_state": _sql((*_FACT, _STATE), "SELECT * FROM mv_state"),
        "mv_order_funnel": _sql((*_FACT, _FUNNEL), "SELECT * FROM mv_funnel"),
        "mv_review_summary": _sql((_REVIEWS, _SUMMARY), "SELECT * FROM mv_reviews"),
        "row_filter_no_group": _sql(_CUSTOMERS, "SELECT customer_id, state FROM dim_customer_keyed WHERE false"),
        "mask_email_no_group": _sql(_CUSTOMERS, f"SELECT customer_id, signup_ts, {_email(False)} AS email "
                                                "FROM slv_customers"),
        "list_column_tags": _sql(_CUSTOMERS, """
            SELECT 'dim_customer' AS table_name, 'email' AS column_name, 'sensitivity' AS tag_name,
              'pii' AS tag_value, count(email) AS filled_rows FROM slv_customers"""),
        "kpi_totals": _sql((*_FACT, _DAILY), """
            SELECT CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
              CAST(sum(order_count) AS BIGINT) AS total_orders FROM mv_daily"""),
        "kpi_month_avg": _sql((*_FACT, _DAILY), f"""
            SELECT year, month, month_name, CAST(revenue AS DOUBLE) AS month_revenue,
              {_mean('sum(revenue) OVER ()', 'count(*) OVER ()', 2)} AS avg_month_revenue
            FROM (SELECT year, month, month_name, sum(CAST(total_revenue AS DECIMAL(18,2))) AS revenue
                  FROM mv_daily GROUP BY ALL)"""),
        "kpi_daily_trend": _sql((*_FACT, _DAILY), f"""
            SELECT full_date, total_revenue,
              {_mean('sum(CAST(total_revenue AS DECIMAL(18,2))) OVER ()', 'count(total_revenue) OVER ()', 2)}
                AS avg_day_revenue FROM mv_daily"""),
        "kpi_pareto": _sql((*_FACT, _CATEGORY), f"""
            SELECT product_category, units_sold, total_revenue,
              {_share('total_revenue', 'sum(total_revenue) OVER ()')} AS revenue_pct,
              {_share('sum(total_revenue) OVER (ORDER BY total_revenue DESC, product_category '
                      'ROWS UNBOUNDED PRECEDING)', 'sum(total_revenue) OVER ()')} AS cumulative_pct
            FROM mv_category"""),
        "kpi_state_shares": _sql((*_FACT, _STATE), f"""
            SELECT state, customer_count, total_revenue,
              {_share('total_revenue', 'sum(total_revenue) OVER ()')} AS revenue_pct FROM mv_state"""),
        "kpi_topk_share": _sql((*_FACT, _STATE), f"""
            SELECT count(*) AS states, {_share('sum(total_revenue)', '(SELECT sum(total_revenue) FROM mv_state)', 3)}
              AS revenue_pct FROM (SELECT * FROM mv_state ORDER BY total_revenue DESC, state LIMIT 2)"""),
        "kpi_top_categories_share": _sql((*_FACT, _CATEGORY), f"""
            SELECT count(*) AS categories,
              {_share('sum(total_revenue)', '(SELECT sum(total_revenue) FROM mv_category)', 3)} AS revenue_pct
            FROM (SELECT * FROM mv_category ORDER BY total_revenue DESC, product_category LIMIT 3)"""),
        "kpi_review_positive": _sql(_REVIEWS, f"""
            SELECT {_share('count(*) FILTER (WHERE score >= 4)', 'count(*)')} AS positive_pct,
              {_share('count(*) FILTER (WHERE score <= 2)', 'count(*)')} AS negative_pct,
              {_mean('sum(score)', 'count(*)', 4)} AS avg_rating FROM slv_reviews"""),
        "kpi_status_rates": _sql(_ORDERS, "SELECT count(*) AS order_count, " + ", ".join(
            f"{_share(f'count(*) FILTER (WHERE order_status = {status!r})', 'count(*)')} AS {name}_pct"
            for status, name in (("delivered", "delivery"), ("canceled", "cancellation"), ("returned", "return"))
        ) + " FROM slv_orders"),
        "top_k_products": _sql(_FACT, f"""
            SELECT product_id, CAST(revenue AS DOUBLE) AS total_revenue,
              {_share('revenue', 'sum(revenue) OVER ()')} AS share_pct
            FROM (SELECT product_id, sum(revenue) AS revenue FROM fct GROUP BY product_id)
            ORDER BY revenue DESC, product_id LIMIT 10"""),
    }
    sql["stream_dedup"] = sql["dedup_lineitem"]
    for name in ("dim_product", "dim_seller", "dim_customer", "dim_customer_keyed"):
        sql[f"medallion_{name}"] = sql[name]
    sql["scd2_incremental_tracked"] = sql["scd2_tracked_columns"]
    sql["br_order_items"] = sql["ingest_csv"]
    sql["br_reviews"] = sql["ingest_fixed_schema"]
    sql["br_payments"] = _sql(_PAYMENTS, "SELECT order_id, payment_type, CAST(n AS INTEGER) AS installment_count "
                                         "FROM log_payments")
    sql["br_orders"] = _sql(_ORDERS, "SELECT order_id, customer_id, raw_status AS order_status, order_date, "
                                     "order_total FROM log_orders")
    sql["br_products"] = _sql(_PRODUCTS, """
        SELECT product_id, '  ' || upper(product_category) || ' ' AS product_category,
          ' ' || product_name || ' ' AS product_name, base_price, weight_grams FROM log_products""")
    sql["br_sellers"] = _sql(_SELLERS, """
        SELECT seller_id, ' ' || seller_name AS seller_name, ' ' || lower(seller_city) || '  ' AS seller_city,
          ' ' || lower(seller_state) || ' ' AS seller_state FROM log_sellers""")
    sql["br_customers"] = _sql(_CUSTOMERS, """
        SELECT customer_id, customer_name,
          CASE WHEN email LIKE '%.example' THEN ' ' || email || ' ' ELSE email END AS email,
          CASE WHEN city LIKE 'Port%' THEN '  ' || lower(city) || ' ' ELSE 'NEW ' || lower(substr(city, 5)) END AS city,
          ' ' || lower(state) || ' ' AS state, signup_date FROM log_customers""")
    columns = ("order_id, item_seq, customer_id, valid_from, product_id, seller_id, date_sk, quantity, "
               "CAST(unit_price AS DOUBLE) AS unit_price, CAST(revenue AS DOUBLE) AS revenue, order_status")
    sql["fct_sales"] = sql["medallion_fct_sales"] = _sql(_FACT, f"SELECT {columns} FROM fct")
    sql["fct_sales_as_of_event"] = _sql(_EVENT_FACT, f"SELECT {columns} FROM fct")
    for entity, (parts, _) in _RULE_SQL.items():
        select = "SELECT * FROM slv_" + entity
        if entity == "order_items":
            select = "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM slv_order_items"
        sql[f"slv_{entity}"] = _sql(parts, select)
        sql[f"dq_metrics_{entity}"] = _metrics_sql(entity)
    sql["dq_metrics_stream"] = " UNION ALL ".join(f"SELECT * FROM ({_metrics_sql(e)})" for e in _RULE_SQL)
    for role, sees_mail, where in (
        ("engineer", True, "true"), ("analyst", False, "true"), ("bi_reader", False, "state = 'TX'"),
    ):
        tagged = "email" if sees_mail else "'***REDACTED-PII***'"
        layers = [("bronze", sees_mail), ("silver", sees_mail), ("gold", True)]
        sql[f"mask_email_{role}"] = _sql(
            _CUSTOMERS, f"SELECT customer_id, {_email(sees_mail)} AS email, valid_from FROM dim_customer_keyed")
        sql[f"row_filter_{role}"] = _sql((*_FACT, _STATE), f"SELECT * FROM mv_state WHERE {where}")
        sql[f"tag_policy_mask_{role}"] = _sql(
            _CUSTOMERS, f"SELECT customer_id, {tagged} AS email, signup_ts FROM dim_customer")
        sql[f"layer_visibility_{role}"] = _sql(_SELLERS, " UNION ALL ".join(
            f"SELECT 'sellers' AS table_name, '{layer}' AS layer, {str(ok).lower()} AS readable, "
            + ("count(*)" if ok else "0 * count(*)") + " AS row_count FROM slv_sellers"
            for layer, ok in layers))
    return sql
