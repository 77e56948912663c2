"""Queries over the whole test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.operators import asof, cluster, conform, feed, history, prepare, quality
from siltstone.plans import catalog, marts
from siltstone.schemas import LoadSpec
from siltstone.session import tune, workspace
from siltstone.sources.ingest import extract, ingest, ingest_all
from siltstone.sources.readers import FrameSource, ParquetSource
from siltstone.sources.store import LoadStore
from siltstone.streaming import files, loads
from siltstone.streaming.changes import ChangeTarget
from workload import views

# Points in time used by the queries below and by their oracles.
BACKDATE = "1996-06-30 00:00:00"
WATERMARK = "1998-01-01 00:00:00"
EARLIER, LATER = "1997-01-01 00:00:00", "1999-01-01 00:00:00"
EVENT_INSTANT = "2024-01-15 12:00:00"
FEED_SINCE = "2024-01-10 00:00:00"
ORDER_LOAD = LoadSpec("dbo", "orders", "o_orderdate", "", "incremental")

# -- gold ----------------------------------------------------------------------------------


def _plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, since engines differ in the types of decimal sums and averages."""
    decimals = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def _mart(spec: marts.MartSpec) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _plain_numbers(marts.build(spec, views.warehouse(spark, sf)))


def gold_publish(spark: SparkSession, sf: str) -> DataFrame:
    store = LoadStore(spark, workspace(spark, "gold"))
    spec = catalog.AGG_PRODUCT_PERFORMANCE
    return _plain_numbers(marts.publish(spec, marts.build(spec, views.warehouse(spark, sf)), store))


def gold_publish_months(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales in month folders, read back."""
    store = LoadStore(spark, workspace(spark, "gold"))
    spec = replace(catalog.AGG_DAILY_SALES, grain="month")
    return _plain_numbers(marts.publish(spec, marts.build(spec, views.warehouse(spark, sf)), store))


def gold_current_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per customer and status, from the open versions of a history instead of the log."""
    spec = marts.MartSpec(
        name="open_status",
        kind="aggregate",
        sources=(marts.Source("FactOrder", "o"), marts.Source("DimCustomer", "c")),
        joins=(marts.Join("o", "c", (("customer_id", "customer_id"),), "left"),),
        select=("c.customer_state AS customer_state", "o.order_status AS order_status", "COUNT(o.customer_id) AS customers"),
        group_by=("c.customer_state", "o.order_status"),
    )
    tables = marts.inputs(views.warehouse(spark, sf), {"FactOrder": scd2_orders(spark, sf)})
    return marts.build(spec, tables)


def zorder_preserves_rows(spark: SparkSession, sf: str) -> DataFrame:
    items = views.table(spark, sf, "lineitem")
    return cluster.zorder(items, ["l_partkey", "l_shipdate"])


def zorder_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Whether clustering leaves a key in at most half as many files, by the least and greatest value of each file: for a text
    whose first bytes are all alike and a decimal.  The keys of every tenth order are looked for."""
    orders = views.table(spark, sf, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 12, "0")).alias("customer"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        (F.col("o_orderkey") % 10 == 0).alias("asked"),
    )
    columns, root = ["customer", "price"], workspace(spark, "layout")
    orders.repartition(64, F.xxhash64(*columns)).write.parquet(f"{root}/before")
    before = spark.read.parquet(f"{root}/before")
    cluster.zorder(before, columns, files=64).write.parquet(f"{root}/after")
    after = spark.read.parquet(f"{root}/after")

    def covering(rows: DataFrame, name: str) -> Column:
        """The files that may hold the key of a row, by the least and greatest value of each of the 64."""
        file = F.col("_metadata.file_path")
        ends = rows.groupBy(file.alias("file")).agg(F.min(name).alias("least"), F.max(name).alias("most")).collect()
        kind = rows.schema[name].dataType
        return reduce(add, [F.col(name).between(F.lit(e.least).cast(kind), F.lit(e.most).cast(kind)).cast("int") for e in ends])

    counts = before.where("asked").agg(
        *[F.sum(covering(rows, c)).alias(f"{c}_{n}") for c in columns for n, rows in (("before", before), ("after", after))]
    )
    found = [
        F.struct(F.lit(c).alias("key"), (2 * F.col(f"{c}_after") <= F.col(f"{c}_before")).alias("fewer"), (F.col(f"{c}_after") > 0).alias("found"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*found)))


# -- history -------------------------------------------------------------------------------


def scd2_events(spark: SparkSession, sf: str) -> DataFrame:
    events = views.order_events(spark, sf).drop("value")
    return history.scd2(
        events, ["user_id"], "ts", ["event_id"], deletes="event_type = 'error'", except_columns=["event_id"]
    )


def scd2_orders(spark: SparkSession, sf: str) -> DataFrame:
    return history.scd2(
        views.fact_order(spark, sf),
        ["customer_id"],
        "order_purchase_timestamp",
        ["order_id"],
        except_columns=["order_id", "order_approved_at", "total_payment_value"],
    )


def scd2_tracked(spark: SparkSession, sf: str) -> DataFrame:
    return history.scd2(
        views.order_events(spark, sf),
        ["user_id"],
        "ts",
        ["event_id"],
        deletes="event_type = 'error'",
        except_columns=["event_id"],
        tracked=["event_type"],
    )


def scd2_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Days as sequence, so that most changes of a user tie and their own values decide."""
    events = views.order_events(spark, sf).select("user_id", F.date_trunc("day", "ts").alias("day"), "event_type", "value")
    events = events.withColumn("day", F.col("day").cast("date"))
    return history.scd2(events, ["user_id"], "day", deletes="event_type = 'error'", tracked=["event_type"])


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return history.current(scd2_events(spark, sf))


def scd2_asof(spark: SparkSession, sf: str) -> DataFrame:
    return history.as_of(scd2_events(spark, sf), EVENT_INSTANT)


def scd2_asof_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with what was known of its customer thirty days before."""
    orders = views.fact_order(spark, sf).select(
        "order_id", "customer_id", (F.col("order_purchase_timestamp") - F.expr("INTERVAL '30' DAY")).alias("asked_at")
    )
    versions = scd2_orders(spark, sf).drop("order_purchase_timestamp")
    return asof.asof_join(orders, versions, ["customer_id"], "asked_at")


def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    return history.scd1(
        views.fact_order(spark, sf),
        ["customer_id"],
        "order_purchase_timestamp",
        ["order_id"],
        deletes="order_status = 'P'",
    )


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    order = [
        "shipping_limit_date", "product_id", "seller_id", "price", "freight_value", "order_item_seq",
    ]
    return conform.latest(views.fact_order_item(spark, sf), ["order_id", "order_item_id"], order)


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes between the customer states valid at two instants."""
    versions = scd2_orders(spark, sf)
    keep = ["customer_id", "order_status", "payment_type"]
    old, new = (history.as_of(versions, t).select(*keep) for t in (EARLIER, LATER))
    return feed.change_feed(old, new, ["customer_id"])


def mart_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes between two published versions of the customer mart: from the orders of the
    earlier years, and from all orders."""
    store = LoadStore(spark, workspace(spark, "gold"))
    tables = views.warehouse(spark, sf)
    spec = replace(catalog.DIM_CUSTOMER_ENRICHED, cluster_by=())
    early = F.col("order_purchase_timestamp") <= F.lit(LATER).cast("timestamp_ntz")
    marts.publish(spec, marts.build(spec, {**tables, "FactOrder": tables["FactOrder"].where(early)}), store)
    [first] = store.visible(spec.name)
    marts.publish(spec, marts.build(spec, tables), store)
    changes = feed.table_changes(store, spec.name, ["customer_id"], first.load_id)
    return changes.select("customer_id", "total_orders", "last_order_date", feed.CHANGE)


# -- silver --------------------------------------------------------------------------------


def _raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Order items as text, with values that do not convert."""
    line = views.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return line.select(
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_returnflag") == "A", "first").otherwise(F.col("l_linenumber").cast("string")).alias("order_item_seq"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_linestatus") == "O", "soon").otherwise(F.col("l_shipdate").cast("string")).alias("shipping_limit_date"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("1000000"), price)).otherwise(price).alias("price"),
        F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("freight_value"),
    )


def conform_types(spark: SparkSession, sf: str) -> DataFrame:
    out = conform.conform(_raw_items(spark, sf), schemas.FACT_ORDER_ITEM, stamp=False)
    return out.withColumn("shipping_limit_date", F.col("shipping_limit_date").cast("timestamp_ntz"))


def conform_losses(spark: SparkSession, sf: str) -> DataFrame:
    return conform.conversion_losses(_raw_items(spark, sf), schemas.FACT_ORDER_ITEM)


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.dim_customer(spark, sf).select(
        F.when(F.col("customer_city") != "BUILDING", F.col("customer_id")).alias("customer_id"),
        F.concat(F.lit("  "), "customer_unique_id", F.lit(" ")).alias("customer_unique_id"),
        "customer_zip_code_prefix",
        F.concat("customer_city", F.lit("   ")).alias("customer_city"),
        F.concat(F.lit(" "), F.lower("customer_state")).alias("customer_state"),
    )
    return conform.clean(raw, schemas.DIM_CUSTOMER)


ITEM_RULES = {**schemas.FACT_ORDER_ITEM.rules, **schemas.DOCUMENTED_ITEM_RULES}


def _doubtful_items(spark: SparkSession, sf: str) -> DataFrame:
    """Order items with refunds as negative prices, unknown prices and missing line numbers."""
    items = views.fact_order_item(spark, sf).withColumn(schemas.INGESTED_AT, F.current_timestamp())
    refund = F.when(F.col("freight_value") > 45, -F.col("price"))
    unknown = F.when(F.col("freight_value") >= 10, F.col("price"))
    return items.withColumns(
        {"price": F.coalesce(refund, unknown), "order_item_id": F.nullif("order_item_id", F.lit(7))}
    )


def quality_items(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expect(_doubtful_items(spark, sf).drop(schemas.INGESTED_AT), ITEM_RULES)


def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    rules = {**ITEM_RULES, "known_line": quality.in_set("order_item_id", ["1", "2", "3", "4"])}
    return quality.counts(_doubtful_items(spark, sf), rules)


ORDER_RULES = {
    "valid_order": "order_id IS NOT NULL",
    "valid_status": quality.in_set("order_status", ["F", "O"]),
    "valid_value": "total_payment_value >= 1000",
}


def _divided_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders, some without a known value, divided by their rules."""
    orders = views.fact_order(spark, sf)
    known = F.when(F.col("order_id") % 11 != 0, F.col("total_payment_value")).alias("total_payment_value")
    rows = orders.select(*[c for c in orders.columns if c not in ("total_payment_value", "order_approved_at")], known)
    return quality.divide(rows, ORDER_RULES, LoadStore(spark, workspace(spark, "checked")), "FactOrder", "b0")


def quality_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The history of customers from the orders that keep all rules."""
    good, _ = _divided_orders(spark, sf)
    return history.scd2(
        good, ["customer_id"], "order_purchase_timestamp", ["order_id"], except_columns=["order_id", "total_payment_value"]
    )


def quality_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The other orders, with the rules they break."""
    _, bad = _divided_orders(spark, sf)
    return bad.select("order_id", "customer_id", "order_status", F.array_join("_failed", ",").alias("failed"))


# -- bronze --------------------------------------------------------------------------------


def _bronze(spark: SparkSession) -> LoadStore:
    return LoadStore(spark, workspace(spark, "bronze"))


def ingest_full(spark: SparkSession, sf: str) -> DataFrame:
    store = _bronze(spark)
    ingest(spark, ParquetSource(sf), LoadSpec("dbo", "lineitem"), store)
    return store.read("lineitem")


def extract_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of an incremental load alone, without writing them."""
    return extract(views.table(spark, sf, "orders"), ORDER_LOAD, WATERMARK)


def _ingest_orders(spark: SparkSession, sf: str, load: LoadSpec) -> LoadStore:
    """One load of orders after an earlier one that left a watermark."""
    store = _bronze(spark)
    store.commit("orders", "earlier", "incremental", rows=0, cdc=WATERMARK, schema=views.table(spark, sf, "orders").schema.json())
    ingest(spark, ParquetSource(sf), load, store)
    return store


def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest_orders(spark, sf, ORDER_LOAD).read("orders")


def ingest_backdate(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest_orders(spark, sf, replace(ORDER_LOAD, from_date=BACKDATE)).read("orders")


def watermark_last(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarks after one load of orders; events were never loaded."""
    store = _ingest_orders(spark, sf, ORDER_LOAD)
    return store.watermark("orders").unionByName(store.watermark("events"))


def watermark_max(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger's facts about a load of events."""
    store = _bronze(spark)
    ingest(spark, ParquetSource(sf), LoadSpec("dbo", "events", "ts", "", "incremental"), store, count_nulls=True)
    return store.ledger("events").select("table", "strategy", "rows", "cdc", "lower_bound", "gap", "null_cdc_rows")


@contextmanager
def _zone(spark: SparkSession, name: str):
    """The session in another time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def watermark_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Events as instants, in two loads by sessions of different zones; the second finds all of them."""
    store = _bronze(spark)
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, ts)")
    events = views.table(spark, sf, "events").withColumn("ts", F.timestamp_micros(micros))
    load = LoadSpec("dbo", "events", "ts", "", "incremental", ("event_id",))
    until = micros <= F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, TIMESTAMP_NTZ '{EVENT_INSTANT}')")
    early = views.table(spark, sf, "events").where(until).withColumn("ts", F.timestamp_micros(micros))
    for zone, rows in (("America/New_York", early), ("Asia/Tokyo", events)):
        with _zone(spark, zone):
            ingest(spark, FrameSource({"events": rows}), load, store)
    seconds = F.expr("make_dt_interval(0, 0, 0, CAST(unix_micros(ts) / 1000000 AS DECIMAL(18,6)))")
    return store.read("events").withColumn("ts", F.expr(_EPOCH) + seconds)


def watermark_bigint(spark: SparkSession, sf: str) -> DataFrame:
    """Events by a number that many of them share, in three loads that end inside one number's rows."""
    store, events = _bronze(spark), views.table(spark, sf, "events")
    load = LoadSpec("dbo", "events", "user_id", "", "incremental", ("event_id",))
    place = F.struct("user_id", "event_id")
    ends = [F.struct(F.lit(u).cast("bigint"), F.lit(e).cast("bigint")) for u, e in ((7, 500), (12, 300))]
    for rows in (events.where(place < ends[0]), events.where(place < ends[1]), events):
        ingest(spark, FrameSource({"events": rows}), load, store)
    return store.read("events")


def ingest_all_status(spark: SparkSession, sf: str) -> DataFrame:
    config = [
        LoadSpec("dbo", "customer"),
        LoadSpec("dbo", "part"),
        LoadSpec("dbo", "supplier"),
        ORDER_LOAD,
        LoadSpec("dbo", "events", "ts", WATERMARK, "incremental"),
        LoadSpec("dbo", "lineitem"),
    ]
    return ingest_all(spark, ParquetSource(sf), config, _bronze(spark), parallel=4)


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, the second with a column the first lacks, read as one table."""
    store, orders = _bronze(spark), views.table(spark, sf, "orders")
    first = F.col("o_orderdate") <= F.lit(WATERMARK).cast("timestamp_ntz")
    store.put(orders.where(first).drop("o_orderpriority"), "orders")
    store.put(orders.where(~first), "orders")
    return store.read("orders")


def schema_widening(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, the second with more digits and with text where numbers were; silver keeps numbers, and beside
    them what is none."""
    store, orders = _bronze(spark), views.table(spark, sf, "orders")
    first = F.col("o_orderdate") <= F.lit(WATERMARK).cast("timestamp_ntz")
    code = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    store.put(
        orders.where(first).select(
            F.col("o_orderkey").cast("int").alias("order_id"), F.col("o_custkey").cast("int").alias("code"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"), F.col("o_orderdate").cast("date").alias("day"),
        ),
        "orders",
    )
    store.put(
        orders.where(~first).select(
            F.col("o_orderkey").alias("order_id"), code.alias("code"),
            (F.col("o_totalprice").cast("decimal(12,2)") * F.lit(10000).cast("decimal(5,0)") + F.lit("0.125").cast("decimal(4,3)")).cast("decimal(20,3)").alias("amount"),
            F.col("o_orderdate").alias("day"),
        ),
        "orders",
    )
    spec = schemas.TableSpec("orders", {"order_id": None, "code": "int", "amount": None, "day": None}, keys=("order_id",))
    silver = conform.conform(store.read("orders"), spec, stamp=False, rescue=True)
    return silver.withColumns({"amount": F.col("amount").cast("string"), conform.RESCUED: F.col(conform.RESCUED)["code"]})


# -- streams -------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table as a file stream (written as a glob, so that a file or a folder will do)."""
    schema = views.table(spark, sf, name).schema
    return files.file_stream(spark, f"{sf}/{name}.parque[t]", schema)


def _append(spark: SparkSession, rows: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    root = workspace(spark, "silver")
    out = conform.conform(rows, spec)
    files.finish(files.start_append(out, f"{root}/data", f"{root}/checkpoint"))
    return spark.read.schema(out.schema).parquet(f"{root}/data").drop(schemas.INGESTED_AT)


def _ntz(spec: schemas.TableSpec) -> schemas.TableSpec:
    """The spec with wall-clock timestamps, the type the test tables use."""
    return replace(spec, columns={c: "timestamp_ntz" if k == "timestamp" else k for c, k in spec.columns.items()})


def _order_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("string").alias("order_purchase_timestamp"),
        F.col("o_totalprice").alias("total_payment_value"),
        F.col("o_orderpriority").alias("payment_type"),
    )


ORDER_SPEC = _ntz(
    replace(
        schemas.FACT_ORDER,
        columns={
            c: k
            for c, k in schemas.FACT_ORDER.columns.items()
            if not c.startswith(("order_delivered", "order_estimated", "order_approved"))
        },
    )
)


def stream_append_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _append(spark, _order_columns(_stream(spark, sf, "orders")), ORDER_SPEC)


def stream_append_items(spark: SparkSession, sf: str) -> DataFrame:
    items = _stream(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_seq"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )
    checked = quality.expect(items, schemas.FACT_ORDER_ITEM.rules)
    return _append(spark, checked, _ntz(schemas.FACT_ORDER_ITEM))


def stream_loads_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two committed bronze loads and one that never committed, through the ledger-driven stream."""
    root = workspace(spark, "lake")
    bronze, silver = LoadStore(spark, f"{root}/bronze"), LoadStore(spark, f"{root}/silver")
    orders = _order_columns(views.table(spark, sf, "orders"))
    first = F.col("order_purchase_timestamp") <= WATERMARK
    bronze.put(orders.where(first), "FactOrder")
    bronze.write(orders, "FactOrder", "crashed")
    bronze.put(orders.where(~first), "FactOrder")
    files.finish(loads.start_conform(bronze, silver, ORDER_SPEC, f"{root}/checkpoint", max_loads=1))
    return silver.read("FactOrder").drop(schemas.INGESTED_AT)


def stream_scd2_events(spark: SparkSession, sf: str) -> DataFrame:
    root = workspace(spark, "history")
    target = ChangeTarget(
        LoadStore(spark, root), "events", ("user_id",), "ts", ("event_id",),
        deletes="event_type = 'error'", except_columns=("event_id",), buckets=8,
    )
    feed_of_events = _stream(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    files.finish(target.start(feed_of_events, f"{root}/checkpoint"))
    return target.table()


def stream_scd1_orders(spark: SparkSession, sf: str) -> DataFrame:
    root = workspace(spark, "latest")
    target = ChangeTarget(
        LoadStore(spark, root), "orders", ("o_custkey",), "o_orderdate", ("o_orderkey",),
        deletes="o_orderstatus = 'P'", scd_type=1, buckets=8,
    )
    files.finish(target.start(_stream(spark, sf, "orders"), f"{root}/checkpoint"))
    return target.table()


def _batches(target: ChangeTarget, rows: DataFrame, sequence: str, middle: str, key: str) -> DataFrame:
    """``rows`` in three batches: the earlier ones but for some that come late, the later ones together with
    repeats of the first batch, and what was held back together with repeats of both."""
    early, held = F.col(sequence) <= F.lit(middle).cast("timestamp_ntz"), F.col(key) % 97 == 0
    repeated = F.col(key) % 5 == 0
    target.apply(rows.where(early & ~held), 0)
    target.apply(rows.where(~early | (repeated & ~held)), 1)
    target.apply(rows.where(held | repeated), 2)
    return target.table()


def _event_target(spark: SparkSession) -> ChangeTarget:
    return ChangeTarget(
        LoadStore(spark, workspace(spark, "history")), "events", ("user_id",), "ts", ("event_id",),
        deletes="event_type = 'error'", except_columns=("event_id",), buckets=8,
    )


def stream_scd2_batches(spark: SparkSession, sf: str) -> DataFrame:
    """History from three batches, one with repeats and one with late changes."""
    rows = views.order_events(spark, sf).drop("value")
    return _batches(_event_target(spark), rows, "ts", EVENT_INSTANT, "event_id")


def stream_scd1_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Latest orders from the same kind of batches."""
    target = ChangeTarget(
        LoadStore(spark, workspace(spark, "latest")), "orders", ("o_custkey",), "o_orderdate", ("o_orderkey",),
        deletes="o_orderstatus = 'P'", scd_type=1, buckets=8,
    )
    return _batches(target, views.table(spark, sf, "orders"), "o_orderdate", WATERMARK, "o_orderkey")


def history_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """What a history of users from two batches, the second with repeats, records after an instant."""
    target, rows = _event_target(spark), views.order_events(spark, sf).drop("value")
    early = F.col("ts") <= F.lit(EVENT_INSTANT).cast("timestamp_ntz")
    target.apply(rows.where(early), 0)
    target.apply(rows.where(~early | (F.col("event_id") % 5 == 0)), 1)
    return target.changes(since=FEED_SINCE).drop("ts")


# -- preparation ---------------------------------------------------------------------------


def payment_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the payments of a customer."""
    rolled = prepare.payment_rollup(
        views.fact_order(spark, sf), "customer_id", "total_payment_value", "payment_type"
    )
    return _plain_numbers(rolled)


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.dim_date(views.table(spark, sf, "orders"), "o_orderdate")


def sample_random(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.sample_random(views.dim_product(spark, sf), ["product_id"], 10)


def sample_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.sample_by_date(
        views.table(spark, sf, "orders"), "o_orderdate", ["o_orderkey"], 10, grain="month"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_fact_sales_summary": _mart(catalog.FACT_SALES_SUMMARY),
    "gold_dim_customer_enriched": _mart(catalog.DIM_CUSTOMER_ENRICHED),
    "gold_agg_daily_sales": _mart(catalog.AGG_DAILY_SALES),
    "gold_agg_product_performance": _mart(catalog.AGG_PRODUCT_PERFORMANCE),
    "gold_publish": gold_publish,
    "gold_publish_months": gold_publish_months,
    "gold_current_customers": gold_current_customers,
    "zorder_preserves_rows": zorder_preserves_rows,
    "zorder_spread": zorder_spread,
    "scd2_events": scd2_events,
    "scd2_orders": scd2_orders,
    "scd2_tracked": scd2_tracked,
    "scd2_ties": scd2_ties,
    "scd2_current": scd2_current,
    "scd2_asof": scd2_asof,
    "scd2_asof_join": scd2_asof_join,
    "scd1_latest": scd1_latest,
    "dedup_latest": dedup_latest,
    "change_feed": change_feed,
    "mart_change_feed": mart_change_feed,
    "conform_types": conform_types,
    "conform_losses": conform_losses,
    "clean_rows": clean_rows,
    "quality_items": quality_items,
    "quality_counts": quality_counts,
    "quality_orders": quality_orders,
    "quality_rejects": quality_rejects,
    "ingest_full": ingest_full,
    "extract_incremental": extract_incremental,
    "ingest_incremental": ingest_incremental,
    "ingest_backdate": ingest_backdate,
    "watermark_last": watermark_last,
    "watermark_max": watermark_max,
    "watermark_zone": watermark_zone,
    "watermark_bigint": watermark_bigint,
    "ingest_all_status": ingest_all_status,
    "schema_evolution": schema_evolution,
    "schema_widening": schema_widening,
    "stream_append_orders": stream_append_orders,
    "stream_append_items": stream_append_items,
    "stream_loads_orders": stream_loads_orders,
    "stream_scd2_events": stream_scd2_events,
    "stream_scd1_orders": stream_scd1_orders,
    "stream_scd2_batches": stream_scd2_batches,
    "stream_scd1_batches": stream_scd1_batches,
    "history_change_feed": history_change_feed,
    "payment_rollup": payment_rollup,
    "dim_date": dim_date,
    "sample_random": sample_random,
    "sample_by_date": sample_by_date,
}


def tuned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: query(tune(spark), sf)
