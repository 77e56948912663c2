"""Both loads of the manual two-step scenario through every layer."""

from siltstone.operators.history import END, current
from siltstone.plans import catalog
from siltstone.plans.lake import Lake
from siltstone.plans.marts import build
from siltstone.schemas import LOADS, documented
from siltstone.sources.readers import FrameSource

CONFIG = [l for l in LOADS if l.table in ("DimCustomer", "DimProduct", "FactOrder", "FactOrderItem")]


def source(spark, step):
    """The source database before (1) and after (2) the incremental script."""
    customers = [("c1", "u1", 1, "rio", "RJ", "2024-01-01 00:00:00"), ("c2", "u2", 2, "natal", "RN", "2024-01-01 00:00:00")]
    products = [("p1", "toys", "2024-01-01 00:00:00")]
    orders = [
        ("o1", "c1", "processing", "2024-01-02 08:00:00", "2024-01-02 09:00:00", "30.00"),
        ("o2", "c2", "processing", "2024-01-02 10:00:00", "2024-01-02 11:00:00", "20.00"),
        ("o9", "c2", "created", "2024-01-02 12:00:00", None, "1.00"),
    ]
    items = [(1, "o1", 1, "p1", "10.00"), (2, "o1", 2, "p1", "20.00"), (3, "o2", 1, "p1", "20.00"), (4, "o2", 2, "p1", "-1.00")]
    if step == 2:
        customers[0] = ("c1", "u1", 1, "niteroi", "RJ", "2024-02-01 00:00:00")
        orders[0] = ("o1", "c1", "delivered", "2024-01-02 08:00:00", "2024-02-02 09:00:00", "30.00")
        orders.append(("o3", "c1", "processing", "2024-02-03 08:00:00", "2024-02-03 09:00:00", "5.00"))
        items.append((5, "o3", 1, "p1", "5.00"))
    return FrameSource({
        "DimCustomer": spark.createDataFrame(
            customers, "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string, updated_at string"
        ),
        "DimProduct": spark.createDataFrame(products, "product_id string, product_category_name string, updated_at string"),
        "FactOrder": spark.createDataFrame(
            orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, total_payment_value string"
        ),
        "FactOrderItem": spark.createDataFrame(
            items, "order_item_id int, order_id string, order_item_seq int, product_id string, price string"
        ),
    })


def test_two_loads_through_all_layers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=4)

    def step(n):
        status = lake.load(source(spark, n), CONFIG, parallel=4)
        lake.conform()
        lake.track()
        return {r.table: r.rows for r in status.collect()}

    def marts(mode):
        tables = lake.tables(mode)
        days = {str(r.sale_date): (r.total_orders, r.total_items, float(r.total_revenue)) for r in build(catalog.AGG_DAILY_SALES, tables).collect()}
        people = {r.customer_id: (r.customer_city, r.total_orders) for r in build(catalog.DIM_CUSTOMER_ENRICHED, tables).collect()}
        return days, people

    assert step(1) == {"DimCustomer": 2, "DimProduct": 1, "FactOrder": 2, "FactOrderItem": 4}
    assert marts("current") == ({"2024-01-02": (2, 3, 50.0)}, {"c1": ("rio", 1), "c2": ("natal", 1)})
    assert marts("log") == ({"2024-01-02": (2, 4, 49.0)}, {"c1": ("rio", 1), "c2": ("natal", 1)})

    [checked] = lake.tracked.visible("FactOrderItem")
    assert checked.counts == {"failed_valid_order_item": 0, "failed_valid_price": 1}

    assert step(2) == {"DimCustomer": 1, "DimProduct": 0, "FactOrder": 2, "FactOrderItem": 5}
    versions = lake.targets["FactOrder"].table()
    statuses = {(r.order_id, r.order_status, r[END] is None) for r in versions.collect()}
    assert statuses == {("o1", "processing", False), ("o1", "delivered", True), ("o2", "processing", True), ("o3", "processing", True)}
    assert {r.customer_city for r in current(lake.targets["DimCustomer"].table()).collect()} == {"niteroi", "natal"}
    # Counting the append log counts every version of o1 and c1.
    assert marts("current") == (
        {"2024-01-02": (2, 3, 50.0), "2024-02-03": (1, 1, 5.0)}, {"c1": ("niteroi", 2), "c2": ("natal", 1)},
    )
    assert marts("log")[0]["2024-01-02"] == (2, 6, 79.0)

    assert step(2) == {"DimCustomer": 0, "DimProduct": 0, "FactOrder": 0, "FactOrderItem": 5}
    assert lake.targets["FactOrder"].table().count() == 4
    assert lake.silver.read("FactOrderItem").count() == 5


def test_refresh_publishes_the_marts(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=2, scd_types={"DimProduct": 1})
    for n in (1, 2):
        lake.refresh(source(spark, n), CONFIG, parallel=4)
    sold = lake.gold.read("agg_product_performance").collect()
    assert [(r.product_id, r.total_units_sold, float(r.total_revenue)) for r in sold] == [("p1", 4, 55.0)]
    lake.vacuum(older_than_hours=-1)
    assert lake.gold.read("fact_sales_summary").count() == 4
    lake.refresh(source(spark, 2), CONFIG)
    assert lake.gold.read("fact_sales_summary").count() == 4


def test_documented_rules_and_lists_in_a_full_run(spark, tmp_path):
    """A bad order opens no version and is kept aside with its rule; cleaning and tracked lists are applied."""
    lake = Lake(spark, str(tmp_path), documented(statuses=["processing", "delivered", "created"]), buckets=2)

    def with_odd_rows(step):
        given = source(spark, step).tables
        odd = [("o7", "c1", "lost", "2024-01-03 08:00:00", "2024-01-03 09:00:00", "1.00"), ("o8", "c1", None, "2024-01-03 08:00:00", "2024-01-03 09:00:00", "1.00")]
        if step == 2:
            odd.append(("o1", "c1", "???", "2024-01-02 08:00:00", "2024-03-02 09:00:00", "30.00"))
        orders = given["FactOrder"].unionByName(spark.createDataFrame(odd, given["FactOrder"].schema))
        city = given["DimCustomer"].selectExpr("customer_id", "concat('u', cast(rand(%d) as string)) customer_unique_id" % step, "customer_zip_code_prefix", "concat('  ', customer_city, ' ') customer_city", "lower(customer_state) customer_state", "updated_at")
        return FrameSource({**given, "FactOrder": orders, "DimCustomer": city})

    for step in (1, 2):
        lake.refresh(with_odd_rows(step), CONFIG, cleaned=True, parallel=4)
    orders = lake.targets["FactOrder"].table()
    assert {(r.order_id, r.order_status) for r in orders.collect()} == {("o1", "processing"), ("o1", "delivered"), ("o2", "processing"), ("o3", "processing")}
    assert sorted((r.order_id, r["_failed"]) for r in lake.rejects("FactOrder").collect()) == [(o, ["valid_status"]) for o in ("o1", "o7", "o8")]
    counts = [load.counts for load in lake.tracked.visible("FactOrder_checked")]
    assert [(c["rejected"], c["failed_valid_status"], c["failed_valid_order"]) for c in counts] == [(2, 2, 0), (1, 1, 0)]
    # customer_unique_id is not on the list: a new one alone opens no version.
    people = lake.targets["DimCustomer"].table().collect()
    assert sorted((r.customer_id, r.customer_city, r.customer_state) for r in people) == [("c1", "niteroi", "RJ"), ("c1", "rio", "RJ"), ("c2", "natal", "RN")]
