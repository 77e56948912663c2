"""The warehouse entities as views of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", "n_name")


def fact_order(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_payment_value"),
        F.col("o_orderpriority").alias("payment_type"),
    )


def fact_order_item(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_seq"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
    )


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.join(_states(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"),
    )


def dim_seller(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    return supplier.join(_states(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def warehouse(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "FactOrder": fact_order(spark, sf),
        "FactOrderItem": fact_order_item(spark, sf),
        "DimCustomer": dim_customer(spark, sf),
        "DimProduct": dim_product(spark, sf),
        "DimSeller": dim_seller(spark, sf),
    }


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """User events as a change feed."""
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")


# The same views as common table expressions for the oracle.
SQL_VIEWS = {
    "fact_order": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
               CAST(o_totalprice AS DECIMAL(10,2)) AS total_payment_value,
               o_orderpriority AS payment_type
        FROM orders""",
    "fact_order_item": """
        SELECT CAST(l_linenumber AS BIGINT) AS order_item_id, l_orderkey AS order_id,
               l_linenumber AS order_item_seq, l_partkey AS product_id, l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "dim_customer": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
               n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dim_product": """
        SELECT p_partkey AS product_id, p_type AS product_category_name, p_size AS product_weight_g
        FROM part""",
}


def with_views(body: str, *names: str, **extra: str) -> str:
    """``body`` preceded by the named views and by ``extra`` expressions, in order."""
    parts = {**{n: SQL_VIEWS[n] for n in names}, **extra}
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in parts.items()) + "\n" + body
