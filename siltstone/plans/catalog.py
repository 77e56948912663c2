"""The four marts of the e-commerce schema.

Grain, columns and measures are fixed values.  How they are computed is chosen for large
tables: a fact that is only summed up is first summed by its join key, and customers are joined
to orders before orders fan out to items.  Prices have two decimals, so partial sums run in whole
cents, which hash aggregation holds as plain longs; an overflow is an error, never a wrap, and so is a
price with a fraction of a cent, never a cut.
"""

from __future__ import annotations

from siltstone.plans.marts import Join, MartSpec, Source



def _cents(column: str) -> str:
    exact = f"{column} IS NULL OR {column} * 100 = CAST({column} * 100 AS BIGINT)"
    error = f"raise_error('{column} has a fraction of a cent')"
    return f"SUM(CASE WHEN {exact} THEN CAST({column} * 100 AS BIGINT) ELSE CAST({error} AS BIGINT) END)"


_PRICE_CENTS = f"{_cents('price')} AS price_cents"
_REVENUE = "CAST(SUM(oi.price_cents) * 0.01BD AS DECIMAL(20,2))"
_AVG_PRICE = "CAST(try_divide(SUM(oi.price_cents) * 0.01BD, SUM(oi.price_count)) AS DECIMAL(14,6))"

FACT_SALES_SUMMARY = MartSpec(
    name="fact_sales_summary",
    kind="fact",
    sources=(
        Source("FactOrder", "o"),
        Source("DimCustomer", "c"),
        Source("FactOrderItem", "oi"),
        Source("DimProduct", "p"),
    ),
    joins=(
        Join("o", "c", (("customer_id", "customer_id"),), "left"),
        Join("o", "oi", (("order_id", "order_id"),), "inner"),
        Join("oi", "p", (("product_id", "product_id"),), "left"),
    ),
    select=(
        "o.order_id",
        "o.customer_id",
        "c.customer_city",
        "c.customer_state",
        "TO_DATE(o.order_purchase_timestamp) AS order_date",
        "oi.product_id",
        "p.product_category_name",
        "oi.price",
        "oi.freight_value",
        "oi.price + oi.freight_value AS total_amount",
    ),
    partition_by=("order_date",),
    cluster_by=("customer_id", "product_id"),
)

DIM_CUSTOMER_ENRICHED = MartSpec(
    name="dim_customer_enriched",
    kind="dimension",
    sources=(
        Source("DimCustomer", "c"),
        Source(
            "FactOrder",
            "o",
            group_by=("customer_id",),
            measures=(
                "COUNT(order_id) AS orders",
                "MAX(order_purchase_timestamp) AS last_purchase",
            ),
        ),
    ),
    joins=(Join("c", "o", (("customer_id", "customer_id"),), "left"),),
    select=(
        "c.customer_id",
        "c.customer_unique_id",
        "c.customer_zip_code_prefix",
        "c.customer_city",
        "c.customer_state",
        "COALESCE(SUM(o.orders), 0) AS total_orders",
        "MAX(o.last_purchase) AS last_order_date",
    ),
    group_by=(
        "c.customer_id",
        "c.customer_unique_id",
        "c.customer_zip_code_prefix",
        "c.customer_city",
        "c.customer_state",
    ),
    partition_by=("customer_state",),
    cluster_by=("customer_id",),
)

AGG_DAILY_SALES = MartSpec(
    name="agg_daily_sales",
    kind="aggregate",
    sources=(
        Source("FactOrder", "o"),
        Source(
            "FactOrderItem",
            "oi",
            group_by=("order_id",),
            measures=(
                "COUNT(order_item_id) AS items",
                _PRICE_CENTS,
                "COUNT(price) AS price_count",
                f"{_cents('freight_value')} AS freight_cents",
            ),
        ),
    ),
    joins=(Join("o", "oi", (("order_id", "order_id"),), "inner"),),
    select=(
        "TO_DATE(o.order_purchase_timestamp) AS sale_date",
        "COUNT(DISTINCT o.order_id) AS total_orders",
        "SUM(oi.items) AS total_items",
        f"{_REVENUE} AS total_revenue",
        "CAST(SUM(oi.freight_cents) * 0.01BD AS DECIMAL(20,2)) AS total_freight",
        f"{_AVG_PRICE} AS avg_item_price",
    ),
    group_by=("TO_DATE(o.order_purchase_timestamp)",),
    partition_by=("sale_date",),
)

AGG_PRODUCT_PERFORMANCE = MartSpec(
    name="agg_product_performance",
    kind="aggregate",
    sources=(
        Source(
            "FactOrderItem",
            "oi",
            group_by=("product_id",),
            measures=(
                "COUNT(order_item_id) AS items",
                _PRICE_CENTS,
                "COUNT(price) AS price_count",
                "MIN(price) AS price_min",
                "MAX(price) AS price_max",
            ),
        ),
        Source("DimProduct", "p"),
    ),
    joins=(Join("oi", "p", (("product_id", "product_id"),), "left"),),
    select=(
        "oi.product_id",
        "p.product_category_name",
        "SUM(oi.items) AS total_units_sold",
        f"{_REVENUE} AS total_revenue",
        f"{_AVG_PRICE} AS avg_price",
        "MIN(oi.price_min) AS min_price",
        "MAX(oi.price_max) AS max_price",
    ),
    group_by=("oi.product_id", "p.product_category_name"),
    partition_by=("product_category_name",),
    cluster_by=("product_id",),
)

MARTS = (FACT_SALES_SUMMARY, DIM_CUSTOMER_ENRICHED, AGG_DAILY_SALES, AGG_PRODUCT_PERFORMANCE)
