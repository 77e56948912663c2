from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.plans import catalog
from siltstone.plans.marts import Join, MartSpec, Source, build, build_all, inputs, publish
from siltstone.sources.store import LoadStore
from workload import views

SF = "/root/testdata/sf0.001"

# The marts' metadata as a user states it, joining first and aggregating after.
ALIASES = {"FactOrder": "o", "FactOrderItem": "oi", "DimProduct": "p", "DimCustomer": "c"}
ORDER_ITEM = {"left": "FactOrder", "right": "FactOrderItem", "on": "order_id", "type": "inner"}
STATED = [
    {
        "name": "fact_sales_summary",
        "source_tables": ["FactOrder", "FactOrderItem", "DimProduct", "DimCustomer"],
        "joins": [
            ORDER_ITEM,
            {"left": "FactOrderItem", "right": "DimProduct", "on": "product_id", "type": "left"},
            {"left": "FactOrder", "right": "DimCustomer", "on": [["customer_id", "customer_id"]], "type": "LEFT OUTER"},
        ],
        "select_columns": list(catalog.FACT_SALES_SUMMARY.select),
    },
    {
        "name": "dim_customer_enriched",
        "source_tables": ["DimCustomer", "FactOrder"],
        "joins": [{"left": "DimCustomer", "right": "FactOrder", "on": "customer_id", "type": "left"}],
        "select_columns": [
            "c.customer_id", "c.customer_unique_id", "c.customer_zip_code_prefix", "c.customer_city", "c.customer_state",
            "COUNT(o.order_id) as total_orders", "MAX(o.order_purchase_timestamp) as last_order_date",
        ],
        "group_by": ["c.customer_id", "c.customer_unique_id", "c.customer_zip_code_prefix", "c.customer_city", "c.customer_state"],
    },
    {
        "name": "agg_daily_sales",
        "source_tables": ["FactOrder", "FactOrderItem"],
        "joins": [ORDER_ITEM],
        "select_columns": [
            "TO_DATE(o.order_purchase_timestamp) as sale_date",
            "COUNT(DISTINCT o.order_id) as total_orders",
            "COUNT(oi.order_item_id) as total_items",
            "SUM(oi.price) as total_revenue",
            "SUM(oi.freight_value) as total_freight",
            "AVG(oi.price) as avg_item_price",
        ],
        "group_by": ["TO_DATE(o.order_purchase_timestamp)"],
    },
    {
        "name": "agg_product_performance",
        "source_tables": ["FactOrderItem", "DimProduct"],
        "joins": [{"left": "FactOrderItem", "right": "DimProduct", "on": "product_id", "type": "left"}],
        "select_columns": [
            "oi.product_id", "p.product_category_name", "COUNT(oi.order_item_id) as total_units_sold",
            "SUM(oi.price) as total_revenue", "AVG(oi.price) as avg_price", "MIN(oi.price) as min_price",
            "MAX(oi.price) as max_price",
        ],
        "group_by": ["oi.product_id", "p.product_category_name"],
    },
]


def untidy(tables):
    """Several versions of keys, unknown keys and unknown values, as an append log has them."""
    orders, items = tables["FactOrder"], tables["FactOrderItem"]
    products, customers = tables["DimProduct"], tables["DimCustomer"]
    again = orders.where("order_status = 'F'").withColumn("order_purchase_timestamp", F.col("order_purchase_timestamp") + F.expr("INTERVAL 1 DAY"))
    return {
        "FactOrder": orders.unionByName(again).unionByName(orders.withColumn("customer_id", F.lit(None).cast("bigint"))),
        "FactOrderItem": items.withColumn("price", F.when(F.col("freight_value") > 9, F.col("price")))
        .withColumn("product_id", F.when(F.col("order_item_id") < 6, F.col("product_id"))),
        "DimProduct": products.unionByName(products.withColumn("product_category_name", F.lit("other"))),
        "DimCustomer": customers.unionByName(customers),
    }


@pytest.mark.parametrize("meta", STATED, ids=lambda m: m["name"])
@pytest.mark.parametrize("shape", ["tidy", "untidy"])
def test_chosen_plan_equals_the_stated_mart(spark, meta, shape):
    tables = views.warehouse(spark, SF)
    tables = untidy(tables) if shape == "untidy" else tables
    stated = build(MartSpec.from_dict({**meta, "type": "t", "table_aliases": ALIASES}), tables)
    chosen = build(next(m for m in catalog.MARTS if m.name == meta["name"]), tables)
    assert stated.dtypes == chosen.dtypes
    assert stated.exceptAll(chosen).count() == 0 and chosen.exceptAll(stated).count() == 0


def small(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "id int, v string")
    b = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "key int, w int")
    return {"a": a, "b": b}


def pair(how):
    return MartSpec("m", "t", (Source("a", "l"), Source("b", "r")), (Join("l", "r", (("id", "key"),), how),), ("l.v AS v",))


@pytest.mark.parametrize("how,rows", [("inner", 2), ("LEFT", 4), ("left outer", 4), ("RIGHT", 3), ("full outer", 5), ("left semi", 1), ("left anti", 2)])
def test_any_join_type_passes_through(spark, how, rows):
    assert build(pair(how), small(spark)).count() == rows


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError, match="no column nope"):
        build(replace(pair("inner"), joins=(Join("l", "r", (("id", "nope"),)),)), small(spark))
    with pytest.raises(ValueError, match="no table"):
        build(pair("inner"), {"a": spark.range(1)})


def test_inputs_by_mode(spark):
    log = spark.createDataFrame([(1,), (1,)], "id int")
    h = spark.createDataFrame([(1, 1, 2), (1, 2, None)], "id int, __START_AT int, __END_AT int")
    assert inputs({"t": log, "u": log}, {"t": h})["t"].count() == 1
    assert inputs({"t": log}, {"t": h}, "log")["t"].count() == 2
    with pytest.raises(ValueError):
        inputs({}, {}, "other")


def test_publish_replaces_and_registers(spark, tmp_path):
    store = LoadStore(spark, str(tmp_path))
    tables = views.warehouse(spark, SF)
    spec = catalog.DIM_CUSTOMER_ENRICHED
    df = build(spec, tables)
    stored = publish(spec, df, store, "gold_customers")
    assert stored.columns == df.columns and stored.dtypes == df.dtypes
    assert stored.exceptAll(df).count() == 0 and stored.count() == df.count()
    first = spark.table("gold_customers").count()
    fewer = df.where("total_orders > 12")
    publish(spec, fewer, store, "gold_customers")
    assert store.read(spec.name).count() == spark.table("gold_customers").count() == fewer.count() < first
    assert len(store.vacuum(spec.name, older_than_hours=-1)) == 1
    publish(replace(spec, cluster_by=()), fewer.withColumn("note", F.lit("x")), store, "gold_customers")
    assert "note" in spark.table("gold_customers").columns and spark.table("gold_customers").count() == fewer.count()


def test_publish_prunes_folders_and_coarsens_dates(spark, tmp_path):
    store = LoadStore(spark, str(tmp_path))
    df = spark.createDataFrame(
        [(date(2024, m, d), Decimal("1.00")) for m in (1, 2) for d in range(1, 20)], "sale_date date, total decimal(20,2)"
    )
    spec = MartSpec("m", "t", (), (), (), partition_by=("sale_date",), grain="month")
    out = publish(spec, df, store)
    assert out.select("sale_date_month").distinct().count() == 2 and out.count() == 38
    plan = store.read("m", where="sale_date_month = DATE'2024-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_date_month" in plan


def test_all_marts_in_order(spark, tmp_path):
    tables = {n: t.limit(200) if n == "FactOrderItem" else t for n, t in views.warehouse(spark, SF).items()}
    specs = [replace(m, grain="year") for m in catalog.MARTS]
    out = build_all(specs, tables, LoadStore(spark, str(tmp_path)))
    assert list(out) == [m.name for m in catalog.MARTS] and all(df.count() for df in out.values())


def test_a_fraction_of_a_cent_is_never_cut(spark):
    items = spark.sql("SELECT 1L AS order_item_id, 1L AS order_id, 1L AS product_id, CAST(0.0099 AS DECIMAL(10,4)) AS price, CAST(0.01 AS DECIMAL(10,4)) AS freight_value")
    products = spark.sql("SELECT 1L AS product_id, 'x' AS product_category_name")
    with pytest.raises(Exception, match="fraction of a cent"):
        build(catalog.AGG_PRODUCT_PERFORMANCE, {"FactOrderItem": items, "DimProduct": products}).collect()
