"""The expected results, written independently in SQL."""

from __future__ import annotations

from workload.queries import BACKDATE, EARLIER, EVENT_INSTANT, FEED_SINCE, LATER, WATERMARK
from workload.views import with_views

# The average of a decimal(10,2) is a decimal(14,6), rounded half up: exact in whole numbers.
_AVG_PRICE = (
    "CAST((CAST(SUM(oi.price) * 100 AS HUGEINT) * 20000 + COUNT(oi.price)) // (2 * COUNT(oi.price)) AS DOUBLE) / 1000000"
)

_FACT_SALES = with_views(
    """
    SELECT o.order_id, o.customer_id, c.customer_city, c.customer_state,
           CAST(o.order_purchase_timestamp AS DATE) AS order_date,
           oi.product_id, p.product_category_name,
           CAST(oi.price AS DOUBLE) AS price, CAST(oi.freight_value AS DOUBLE) AS freight_value,
           CAST(oi.price + oi.freight_value AS DOUBLE) AS total_amount
    FROM fact_order o
    JOIN fact_order_item oi ON o.order_id = oi.order_id
    LEFT JOIN dim_product p ON oi.product_id = p.product_id
    LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""",
    "fact_order", "fact_order_item", "dim_product", "dim_customer",
)

_CUSTOMERS = with_views(
    """
    SELECT c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city,
           c.customer_state, COUNT(o.order_id) AS total_orders,
           MAX(o.order_purchase_timestamp) AS last_order_date
    FROM dim_customer c LEFT JOIN fact_order o ON c.customer_id = o.customer_id
    GROUP BY ALL""",
    "dim_customer", "fact_order",
)

_DAILY_COLUMNS = f"""
           COUNT(DISTINCT o.order_id) AS total_orders,
           COUNT(oi.order_item_id) AS total_items,
           CAST(SUM(oi.price) AS DOUBLE) AS total_revenue,
           CAST(SUM(oi.freight_value) AS DOUBLE) AS total_freight,
           {_AVG_PRICE} AS avg_item_price
    FROM fact_order o JOIN fact_order_item oi ON o.order_id = oi.order_id
    GROUP BY CAST(o.order_purchase_timestamp AS DATE)"""

_DAILY = with_views(
    f"SELECT CAST(o.order_purchase_timestamp AS DATE) AS sale_date, {_DAILY_COLUMNS}", "fact_order", "fact_order_item"
)
_DAILY_MONTHS = f"SELECT *, CAST(DATE_TRUNC('month', sale_date) AS DATE) AS sale_date_month FROM ({_DAILY}) d"

_PRODUCTS = with_views(
    f"""
    SELECT oi.product_id, p.product_category_name, COUNT(oi.order_item_id) AS total_units_sold,
           CAST(SUM(oi.price) AS DOUBLE) AS total_revenue,
           {_AVG_PRICE} AS avg_price,
           CAST(MIN(oi.price) AS DOUBLE) AS min_price, CAST(MAX(oi.price) AS DOUBLE) AS max_price
    FROM fact_order_item oi LEFT JOIN dim_product p ON oi.product_id = p.product_id
    GROUP BY oi.product_id, p.product_category_name""",
    "fact_order_item", "dim_product",
)

# Versions of users by event type; an error event closes the version before it.
_EVENT_STEPS = {
    "ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS copy
        FROM events""",
    "steps": """
        SELECT *, LAG(event_type) OVER w AS was, ROW_NUMBER() OVER w AS n
        FROM ranked WHERE copy = 1 WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
    "runs": """
        SELECT *, SUM(CASE WHEN n = 1 OR event_type <> was THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts) AS run
        FROM steps""",
    "versions": """
        SELECT user_id, run, MIN(ts) AS first_ts, ARG_MAX(value, ts) AS value,
               ANY_VALUE(event_type) AS event_type,
               LEAD(MIN(ts)) OVER (PARTITION BY user_id ORDER BY run) AS next_ts
        FROM runs GROUP BY user_id, run""",
}
_EVENT_COLUMNS = 'user_id, first_ts AS ts, event_type, first_ts AS "__START_AT", next_ts AS "__END_AT"'


def _events(columns: str = _EVENT_COLUMNS, also: str = "TRUE") -> str:
    return with_views(f"SELECT {columns} FROM versions WHERE event_type <> 'error' AND {also}", **_EVENT_STEPS)


_ORDER_STEPS = {
    "ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS copy
        FROM orders""",
    "steps": """
        SELECT *, LAG(o_orderstatus) OVER w AS status_was, LAG(o_orderpriority) OVER w AS type_was,
               ROW_NUMBER() OVER w AS n
        FROM ranked WHERE copy = 1 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)""",
    "opened": """
        SELECT * FROM steps
        WHERE n = 1 OR o_orderstatus IS DISTINCT FROM status_was OR o_orderpriority IS DISTINCT FROM type_was""",
    "versions": """
        SELECT o_custkey AS customer_id, o_orderstatus AS order_status, o_orderpriority AS payment_type,
               o_orderdate AS order_purchase_timestamp, o_orderdate AS valid_from,
               LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
        FROM opened""",
}
_ORDERS_SCD2 = with_views(
    """
    SELECT customer_id, order_status, order_purchase_timestamp, payment_type,
           valid_from AS "__START_AT", valid_to AS "__END_AT"
    FROM versions""",
    **_ORDER_STEPS,
)


_ORDERS_SCD1 = """
        SELECT * EXCLUDE (newest) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS newest
            FROM orders) r
        WHERE newest = 1 AND o_orderstatus <> 'P'"""


def _valid_at(instant: str) -> str:
    return (
        "SELECT customer_id, order_status, payment_type FROM versions "
        f"WHERE valid_from <= TIMESTAMP '{instant}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{instant}')"
    )


_CHANGE_FEED = with_views(
    """
    SELECT customer_id, n.order_status, n.payment_type, 'insert' AS "_change_type"
    FROM new_rows n ANTI JOIN old_rows o USING (customer_id)
    UNION ALL
    SELECT customer_id, o.order_status, o.payment_type, 'delete'
    FROM old_rows o ANTI JOIN new_rows n USING (customer_id)
    UNION ALL
    SELECT customer_id, old_status, old_type, 'update_preimage' FROM updated
    UNION ALL
    SELECT customer_id, new_status, new_type, 'update_postimage' FROM updated""",
    **_ORDER_STEPS,
    old_rows=_valid_at(EARLIER),
    new_rows=_valid_at(LATER),
    updated="""
        SELECT o.customer_id, o.order_status AS old_status, o.payment_type AS old_type,
               n.order_status AS new_status, n.payment_type AS new_type
        FROM old_rows o JOIN new_rows n ON o.customer_id = n.customer_id
        WHERE o.order_status IS DISTINCT FROM n.order_status OR o.payment_type IS DISTINCT FROM n.payment_type""",
)

_RAW_ITEMS = """
    SELECT CAST(l_linenumber AS VARCHAR) AS order_item_id, l_orderkey AS order_id,
           CASE WHEN l_returnflag = 'A' THEN 'first' ELSE CAST(l_linenumber AS VARCHAR) END AS order_item_seq,
           l_partkey AS product_id, l_suppkey AS seller_id,
           CASE WHEN l_linestatus = 'O' THEN 'soon' ELSE CAST(l_shipdate AS VARCHAR) END AS shipping_limit_date,
           CASE WHEN l_returnflag = 'R' THEN '1000000' ELSE '' END
             || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
           CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) AS freight_value
    FROM lineitem"""
_TYPED = {
    "order_item_id": "BIGINT",
    "order_item_seq": "INTEGER",
    "shipping_limit_date": "TIMESTAMP",
    "price": "DECIMAL(10,2)",
    "freight_value": "DECIMAL(10,2)",
}

_DOUBTFUL = """
    SELECT CASE WHEN order_item_id = 7 THEN NULL ELSE order_item_id END AS order_item_id, order_id,
           order_item_seq, product_id, seller_id, shipping_limit_date,
           CASE WHEN freight_value > 45 THEN -price WHEN freight_value >= 10 THEN price END AS price,
           freight_value
    FROM fact_order_item"""
_RULES = {
    "valid_order_item": "order_item_id IS NOT NULL",
    "valid_price": "price >= 0",
    "valid_order": "order_id IS NOT NULL",
    "valid_freight": "freight_value >= 0",
}

_SILVER_ORDERS = with_views(
    "SELECT order_id, customer_id, order_status, order_purchase_timestamp, total_payment_value, payment_type FROM fact_order",
    "fact_order",
)


def _md5_60(key: str) -> str:
    return f"CAST('0x' || SUBSTR(MD5('0|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


ORACLE: dict[str, str] = {
    "gold_fact_sales_summary": _FACT_SALES,
    "gold_dim_customer_enriched": _CUSTOMERS,
    "gold_agg_daily_sales": _DAILY,
    "gold_agg_product_performance": _PRODUCTS,
    "gold_publish": _PRODUCTS,
    "gold_publish_months": _DAILY_MONTHS,
    "gold_current_customers": with_views(
        """
        SELECT n_name AS customer_state, order_status, COUNT(v.customer_id) AS customers
        FROM versions v LEFT JOIN customer ON c_custkey = v.customer_id LEFT JOIN nation ON c_nationkey = n_nationkey
        WHERE valid_to IS NULL GROUP BY n_name, order_status""",
        **_ORDER_STEPS,
    ),
    "zorder_preserves_rows": "SELECT * FROM lineitem",
    "zorder_spread": "SELECT key, TRUE AS fewer, TRUE AS found FROM (VALUES ('customer'), ('price')) AS t(key)",
    "scd2_events": _events(),
    "scd2_orders": _ORDERS_SCD2,
    "scd2_tracked": _events(_EVENT_COLUMNS + ", value"),
    "scd2_ties": with_views(
        """
        SELECT user_id, first_day AS day, event_type, value, first_day AS "__START_AT", next_day AS "__END_AT"
        FROM versions WHERE event_type <> 'error'""",
        ranked="""
        SELECT user_id, CAST(ts AS DATE) AS day, event_type, value, ROW_NUMBER() OVER (
            PARTITION BY user_id, CAST(ts AS DATE) ORDER BY (event_type = 'error') DESC, event_type DESC, value DESC) AS copy
        FROM events""",
        steps="""
        SELECT *, LAG(event_type) OVER w AS was, ROW_NUMBER() OVER w AS n
        FROM ranked WHERE copy = 1 WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
        runs="""
        SELECT *, SUM(CASE WHEN n = 1 OR event_type <> was THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY day) AS run
        FROM steps""",
        versions="""
        SELECT user_id, run, MIN(day) AS first_day, ARG_MAX(value, day) AS value, ANY_VALUE(event_type) AS event_type,
               LEAD(MIN(day)) OVER (PARTITION BY user_id ORDER BY run) AS next_day
        FROM runs GROUP BY user_id, run""",
    ),
    "scd2_current": _events(also="next_ts IS NULL"),
    "scd2_asof": _events(
        also=f"first_ts <= TIMESTAMP '{EVENT_INSTANT}' AND (next_ts IS NULL OR next_ts > TIMESTAMP '{EVENT_INSTANT}')"
    ),
    "scd2_asof_join": with_views(
        """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate - INTERVAL 30 DAY AS asked_at,
               v.order_status, v.payment_type, v.valid_from AS "__START_AT", v.valid_to AS "__END_AT"
        FROM orders o LEFT JOIN versions v ON v.customer_id = o.o_custkey
             AND v.valid_from <= o.o_orderdate - INTERVAL 30 DAY
             AND (v.valid_to IS NULL OR o.o_orderdate - INTERVAL 30 DAY < v.valid_to)""",
        **_ORDER_STEPS,
    ),
    "scd1_latest": with_views(
        """
        SELECT * EXCLUDE (newest) FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY customer_id ORDER BY order_purchase_timestamp DESC, order_id DESC) AS newest
            FROM fact_order) r
        WHERE newest = 1 AND order_status <> 'P'""",
        "fact_order",
    ),
    "dedup_latest": with_views(
        """
        SELECT * EXCLUDE (newest) FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY order_id, order_item_id
                ORDER BY shipping_limit_date DESC, product_id DESC, seller_id DESC, price DESC,
                         freight_value DESC, order_item_seq DESC) AS newest
            FROM fact_order_item) r
        WHERE newest = 1""",
        "fact_order_item",
    ),
    "change_feed": _CHANGE_FEED,
    "mart_change_feed": with_views(
        """
        SELECT customer_id, total_orders, last_order_date, 'update_preimage' AS "_change_type" FROM (
            SELECT e.* FROM early e JOIN late l USING (customer_id) WHERE e.total_orders <> l.total_orders) a
        UNION ALL
        SELECT customer_id, total_orders, last_order_date, 'update_postimage' FROM (
            SELECT l.* FROM early e JOIN late l USING (customer_id) WHERE e.total_orders <> l.total_orders) b""",
        early=f"""
        SELECT c_custkey AS customer_id, COUNT(o_orderkey) AS total_orders, MAX(o_orderdate) AS last_order_date
        FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{LATER}') o ON c_custkey = o_custkey
        GROUP BY c_custkey""",
        late="""
        SELECT c_custkey AS customer_id, COUNT(o_orderkey) AS total_orders, MAX(o_orderdate) AS last_order_date
        FROM customer LEFT JOIN orders o ON c_custkey = o_custkey GROUP BY c_custkey""",
    ),
    "conform_types": with_views(
        "SELECT order_id, product_id, seller_id, "
        + ", ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t in _TYPED.items())
        + " FROM raw_items",
        raw_items=_RAW_ITEMS,
    ),
    "conform_losses": with_views(
        "SELECT "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS {c}" for c, t in _TYPED.items()
        )
        + " FROM raw_items",
        raw_items=_RAW_ITEMS,
    ),
    "clean_rows": with_views(
        "SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, "
        "UPPER(customer_state) AS customer_state FROM dim_customer WHERE customer_city <> 'BUILDING'",
        "dim_customer",
    ),
    "quality_items": with_views(
        f"SELECT * FROM doubtful WHERE {' AND '.join(_RULES.values())}", "fact_order_item", doubtful=_DOUBTFUL
    ),
    "quality_orders": with_views(
        """
        SELECT customer_id, order_status, order_purchase_timestamp, payment_type,
               valid_from AS "__START_AT", valid_to AS "__END_AT"
        FROM versions""",
        **{
            **_ORDER_STEPS,
            "ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS copy
        FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 11 <> 0
                      AND CAST(o_totalprice AS DECIMAL(10,2)) >= 1000""",
        },
    ),
    "quality_rejects": """
        SELECT order_id, customer_id, order_status, failed FROM (
            SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
                   CONCAT_WS(',', CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'valid_status' END,
                       CASE WHEN o_orderkey % 11 = 0 OR CAST(o_totalprice AS DECIMAL(10,2)) < 1000 THEN 'valid_value' END) AS failed
            FROM orders) r
        WHERE failed <> ''""",
    "quality_counts": with_views(
        " UNION ALL ".join(
            f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {p}) AS passed, "
            f"COUNT(*) - COUNT(*) FILTER (WHERE {p}) AS failed FROM doubtful"
            for name, p in {**_RULES, "known_line": "order_item_id IN (1, 2, 3, 4)"}.items()
        ),
        "fact_order_item",
        doubtful=_DOUBTFUL,
    ),
    "ingest_full": "SELECT * FROM lineitem",
    "extract_incremental": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK}'",
    "ingest_incremental": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK}'",
    "ingest_backdate": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{BACKDATE}'",
    "watermark_last": "SELECT 'orders' AS \"table\", CAST(MAX(o_orderdate) AS VARCHAR) AS cdc FROM orders "
    "UNION ALL SELECT 'events', '1900-01-01'",
    "watermark_max": "SELECT 'events' AS \"table\", 'incremental' AS strategy, COUNT(*) AS rows, "
    "CAST(MAX(ts) AS VARCHAR) AS cdc, '1900-01-01' AS lower_bound, FALSE AS gap, "
    "COUNT(*) - COUNT(ts) AS null_cdc_rows FROM events",
    "watermark_zone": "SELECT * FROM events",
    "watermark_bigint": "SELECT * FROM events",
    "ingest_all_status": " UNION ALL ".join(
        [
            *(
                f"SELECT '{t}' AS \"table\", 'full' AS strategy, COUNT(*) AS rows, CAST(NULL AS VARCHAR) AS cdc FROM {t}"
                for t in ("customer", "part", "supplier", "lineitem")
            ),
            "SELECT 'orders', 'incremental', COUNT(*), CAST(MAX(o_orderdate) AS VARCHAR) FROM orders",
            "SELECT 'events', 'incremental', COUNT(*), CAST(MAX(ts) AS VARCHAR) FROM events "
            f"WHERE ts > TIMESTAMP '{WATERMARK}'",
        ]
    ),
    "schema_evolution": "SELECT * REPLACE (CASE WHEN o_orderdate > "
    f"TIMESTAMP '{WATERMARK}' THEN o_orderpriority END AS o_orderpriority) FROM orders",
    "schema_widening": f"""
        SELECT o_orderkey AS order_id,
               CASE WHEN NOT (later AND o_orderstatus = 'P') THEN CAST(o_custkey AS INTEGER) END AS code,
               CASE WHEN later THEN CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 10000 AS BIGINT) AS VARCHAR) || '.125' AS VARCHAR)
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) || '0' END AS amount,
               CASE WHEN later THEN o_orderdate ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day,
               CASE WHEN later AND o_orderstatus = 'P' THEN 'C' || o_custkey END AS _rescued
        FROM (SELECT *, o_orderdate > TIMESTAMP '{WATERMARK}' AS later FROM orders) o""",
    "stream_append_orders": _SILVER_ORDERS,
    "stream_append_items": with_views(
        "SELECT * FROM fact_order_item WHERE order_item_id IS NOT NULL AND price >= 0", "fact_order_item"
    ),
    "stream_loads_orders": _SILVER_ORDERS,
    "stream_scd2_events": _events(),
    "stream_scd2_batches": _events(),
    "history_change_feed": with_views(
        """
        SELECT user_id, event_type, moment AS "_changed_at",
               CASE WHEN COUNT(*) OVER (PARTITION BY user_id, moment) = 2 AND sign > 0 THEN 'update_postimage'
                    WHEN COUNT(*) OVER (PARTITION BY user_id, moment) = 2 THEN 'update_preimage'
                    WHEN sign > 0 THEN 'insert' ELSE 'delete' END AS "_change_type"
        FROM steps_of WHERE moment > TIMESTAMP '%s'""" % FEED_SINCE,
        **_EVENT_STEPS,
        steps_of="""
        SELECT user_id, event_type, first_ts AS moment, 1 AS sign FROM versions WHERE event_type <> 'error'
        UNION ALL
        SELECT user_id, event_type, next_ts, -1 FROM versions WHERE event_type <> 'error' AND next_ts IS NOT NULL""",
    ),
    "stream_scd1_orders": _ORDERS_SCD1,
    "stream_scd1_batches": _ORDERS_SCD1,
    "payment_rollup": with_views(
        """
        SELECT customer_id, CAST(SUM(total_payment_value) AS DOUBLE) AS total_payment_value,
               FIRST(payment_type ORDER BY total_payment_value DESC, payment_type DESC) AS payment_type
        FROM fact_order GROUP BY customer_id""",
        "fact_order",
    ),
    "dim_date": """
        SELECT CAST(STRFTIME(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
               CAST(YEAR(d) AS INTEGER) AS year, CAST(QUARTER(d) AS INTEGER) AS quarter,
               CAST(MONTH(d) AS INTEGER) AS month, MONTHNAME(d) AS month_name,
               CAST(DAY(d) AS INTEGER) AS day, CAST(ISODOW(d) AS INTEGER) AS day_of_week,
               DAYNAME(d) AS day_name, CAST(WEEKOFYEAR(d) AS INTEGER) AS week_of_year,
               ISODOW(d) >= 6 AS is_weekend
        FROM (SELECT UNNEST(GENERATE_SERIES(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)),
                                            INTERVAL 1 DAY)) AS d FROM orders) s""",
    "sample_random": with_views(
        f"SELECT * FROM dim_product WHERE {_md5_60('product_id')} % 10000 < 1000", "dim_product"
    ),
    "sample_by_date": f"""
        SELECT * EXCLUDE (place, total) FROM (
            SELECT *, RANK() OVER (PARTITION BY DATE_TRUNC('month', o_orderdate) ORDER BY {_md5_60('o_orderkey')}) AS place,
                   COUNT(*) OVER (PARTITION BY DATE_TRUNC('month', o_orderdate)) AS total
            FROM orders) r
        WHERE place <= CEIL(total * 10 / 100.0)""",
}
