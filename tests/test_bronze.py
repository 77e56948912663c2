import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import FIRST_WATERMARK, LOADS, LoadSpec, read_loads, schema_of, wider
from siltstone.sources.ingest import extract, ingest, ingest_all
from siltstone.sources.readers import CatalogSource, FrameSource, JdbcSource, ParquetSource, Split
from siltstone.sources.store import LoadStore

ORDERS = LoadSpec("dbo", "FactOrder", "order_approved_at", "", "incremental")


def orders(spark, *rows):
    data = [(k, datetime.fromisoformat(t) if t else None) for k, t in rows]
    return spark.createDataFrame(data, "order_id long, order_approved_at timestamp")


def source(df, name="FactOrder"):
    return FrameSource({name: df})


@pytest.fixture
def store(spark, tmp_path):
    return LoadStore(spark, str(tmp_path / "bronze"))


def ids(df):
    return sorted(r.order_id for r in df.collect())


def mark(store, table="FactOrder"):
    return store.watermark(table).first().cdc


def test_two_step_load(spark, store):
    first = orders(spark, (1, "2024-01-01"), (2, "2024-01-02"))
    assert mark(store) == FIRST_WATERMARK
    assert ingest(spark, source(first), ORDERS, store) == {
        "table": "FactOrder", "strategy": "incremental", "rows": 2, "cdc": "2024-01-02 00:00:00Z",
    }
    second = orders(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"))
    assert ingest(spark, source(second), ORDERS, store)["rows"] == 1
    assert ids(store.read("FactOrder")) == [1, 2, 3]


def test_no_new_rows_commit_nothing(spark, store):
    df = orders(spark, (1, "2024-01-01"))
    ingest(spark, source(df), ORDERS, store)
    assert ingest(spark, source(df), ORDERS, store) == {
        "table": "FactOrder", "strategy": "incremental", "rows": 0, "cdc": "2024-01-01 00:00:00Z",
    }
    assert store.ledger("FactOrder").count() == 1 and ids(store.read("FactOrder")) == [1]


def test_equal_and_null_values_stay_out_unless_asked_for(spark, store):
    df = orders(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, None))
    last = "2024-01-02"
    assert ids(extract(df, ORDERS, last)) == []
    assert ids(extract(df, ORDERS, last, overlap="2 days")) == [1, 2]
    assert ids(extract(df, ORDERS, last, include_null=True)) == [3]
    ingest(spark, source(df), ORDERS, store, count_nulls=True)
    assert store.ledger("FactOrder").first().null_cdc_rows == 1


def test_backdate_rereads_and_never_moves_the_watermark_back(spark, store):
    df = orders(spark, (1, "2024-01-01"), (2, "2024-01-05"))
    ingest(spark, source(df), ORDERS, store)
    early = orders(spark, (1, "2024-01-01"), (2, "2024-01-04"))
    again = LoadSpec("dbo", "FactOrder", "order_approved_at", "2023-12-31", "incremental")
    assert ingest(spark, source(early), again, store)["rows"] == 2
    assert mark(store) == "2024-01-05 00:00:00Z"
    assert not any(r.gap for r in store.ledger("FactOrder").collect()[1:])


def test_backdate_beyond_the_watermark_is_flagged(spark, store):
    ingest(spark, source(orders(spark, (1, "2024-01-01"))), ORDERS, store)
    late = LoadSpec("dbo", "FactOrder", "order_approved_at", "2024-03-01", "incremental")
    ingest(spark, source(orders(spark, (2, "2024-02-01"), (3, "2024-04-01"))), late, store)
    assert sorted(r.gap for r in store.ledger("FactOrder").collect()) == [False, True]
    assert ids(store.read("FactOrder")) == [1, 3]


def test_failed_load_is_invisible_and_vacuumed(spark, store):
    ingest(spark, source(orders(spark, (1, "2024-01-01"))), ORDERS, store)
    store.write(orders(spark, (9, "2024-02-01")), "FactOrder", "crashed")
    assert ids(store.read("FactOrder")) == [1] and mark(store) == "2024-01-01 00:00:00Z"
    assert store.vacuum("FactOrder") == []
    assert store.vacuum("FactOrder", older_than_hours=-1) == ["crashed"]
    assert ids(store.read("FactOrder")) == [1]


def test_a_committed_load_is_not_discarded(spark, store):
    ingest(spark, source(orders(spark, (1, "2024-01-01"))), ORDERS, store)
    with pytest.raises(ValueError, match="is committed"):
        store.discard("FactOrder", store.visible("FactOrder")[0].load_id)
    assert store.vacuum("never_loaded", older_than_hours=-1) == []


def test_full_load_replaces(spark, store):
    load = LoadSpec("dbo", "FactOrder")
    ingest(spark, source(orders(spark, (1, None), (2, None))), load, store)
    ingest(spark, source(orders(spark, (3, None))), load, store)
    assert ids(store.read("FactOrder")) == [3]
    assert len(store.vacuum("FactOrder", older_than_hours=-1)) == 1


def test_new_column_is_null_in_older_loads(spark, store):
    store.put(orders(spark, (1, "2024-01-01")), "FactOrder")
    store.put(orders(spark, (2, "2024-01-02")).withColumn("note", F.lit("new")), "FactOrder")
    assert {(r.order_id, r.note) for r in store.read("FactOrder").collect()} == {(1, None), (2, "new")}


@pytest.mark.parametrize("one,two,both", [
    ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(38,18)", "decimal(38,18)"), ("bigint", "decimal(38,20)", "string"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,2)", "string"), ("float", "double", "double"),
    ("int", "double", "double"), ("bigint", "double", "string"), ("decimal(10,2)", "double", "string"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", "string"), ("int", "string", "string"), ("boolean", "int", "string"), ("array<int>", "string", "string"), ("date", "date", "date"),
])
def test_the_wider_type(spark, one, two, both):
    a, b = (T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (one, two))
    assert wider(a, b).simpleString() == wider(b, a).simpleString() == both


def test_loads_with_changed_types_lose_nothing(spark, store):
    at = datetime(2024, 1, 1, 12)
    loads = [
        spark.createDataFrame([(1, 5, 7, at, [1, 2])], "id int, a int, b int, t timestamp, l array<int>"),
        spark.createDataFrame([(2, 2**40, "7b", None, None)], "id int, a bigint, b string, t string, l string"),
        spark.createDataFrame([(3, Decimal("0.25"), None, "x", "y", 1)], "id int, a decimal(6,2), b string, t string, l string, new int"),
    ]
    for rows in loads:
        store.put(rows, "t")
    assert {tuple(r) for r in store.read("t").collect()} == {
        (1, Decimal("5.00"), "7", "2024-01-01 12:00:00Z", "[1,2]", None),
        (2, Decimal(2**40), "7b", None, None, None),
        (3, Decimal("0.25"), None, "x", "y", 1),
    }


def test_inferred_schema_is_kept_and_widened(spark, tmp_path):
    data, saved = str(tmp_path / "d"), str(tmp_path / "s")
    spark.range(2).write.parquet(f"{data}/a")
    assert schema_of(spark, f"{data}/*", saved).fieldNames() == ["id"]
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{data}/b")
    assert schema_of(spark, f"{data}/*", saved).fieldNames() == ["id", "x"]


def test_all_tables_in_parallel(spark, store):
    tables = {l.table: orders(spark, (1, "2024-01-01")).withColumn("updated_at", F.col("order_approved_at")) for l in LOADS}
    status = ingest_all(spark, FrameSource(tables), LOADS, store, parallel=3)
    got = {r.table: (r.strategy, r.rows, r.cdc) for r in status.collect()}
    assert got["FactOrder"] == ("incremental", 1, "2024-01-01 00:00:00Z")
    assert got["DimDate"] == ("full", 1, None) and len(got) == 6


def test_one_failing_table_does_not_stop_the_others(spark, store):
    good, bad = LoadSpec("dbo", "FactOrder"), LoadSpec("dbo", "Missing")
    with pytest.raises(KeyError):
        ingest_all(spark, source(orders(spark, (1, None))), [bad, good], store)
    assert ids(store.read("FactOrder")) == [1]


def test_load_configuration_document(spark, tmp_path):
    path = tmp_path / "loads.json"
    path.write_text(json.dumps([
        {"schema": "dbo", "table": "FactOrder", "cdc_column": "order_approved_at", "from_date": "", "load_strategy": "incremental"},
        {"schema": "dbo", "table": "DimDate", "cdc_column": "", "from_date": "", "load_strategy": "full"},
    ]))
    assert read_loads(spark, str(path)) == [ORDERS, LoadSpec("dbo", "DimDate")]
    with pytest.raises(ValueError):
        LoadSpec("dbo", "x", "", "", "incremental")


def test_bound_reaches_the_scan(spark):
    rows = ParquetSource("/root/testdata/sf0.001").read(spark, "dbo", "orders")
    load = LoadSpec("dbo", "orders", "o_orderdate", "", "incremental")
    plan = extract(rows, load, "1997-01-01").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1997-01-01T00:00" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_jdbc_options():
    plain = JdbcSource("jdbc:sqlserver://host")
    assert plain.options("dbo", "DimDate")["dbtable"] == "dbo.DimDate"
    assert "numPartitions" not in plain.options("dbo", "DimDate")
    split = JdbcSource("jdbc:sqlserver://host", splits={"FactOrder": Split("order_key", "0", "1000", 16)})
    assert split.options("dbo", "FactOrder")["numPartitions"] == "16"
    with pytest.raises(ValueError):
        plain.options("dbo", "x; DROP TABLE y")


def test_catalog_source(spark):
    spark.range(3).createOrReplaceTempView("some_orders")
    assert CatalogSource(with_schema=False).read(spark, "", "some_orders").count() == 3
    with pytest.raises(ValueError):
        CatalogSource().read(spark, "dbo", "a b")


@pytest.fixture
def in_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def loaded(spark, store, rows, load):
    ingest(spark, FrameSource({load.table: rows}), load, store)
    return sorted(r.id for r in store.read(load.table).collect())


def test_the_hour_that_occurs_twice(spark, store, in_zone):
    """Two instants that a zone's clock shows alike are two marks, in whatever zone the next session runs."""
    hour = 3600 * 1_000_000
    rows = spark.createDataFrame([(1, 0), (2, hour), (3, 2 * hour)], "id int, after long")
    base = 1730611800 * 1_000_000  # 2024-11-03 05:30 UTC, 01:30 in New York; an hour later it is 01:30 again
    rows = rows.select("id", F.timestamp_micros(F.col("after") + base).alias("at"))
    load = LoadSpec("dbo", "t", "at", "", "incremental")
    in_zone("America/New_York")
    assert loaded(spark, store, rows.where("id = 1"), load) == [1]
    assert store.mark("t")[0] == "2024-11-03 05:30:00Z"
    assert loaded(spark, store, rows.where("id < 3"), load) == [1, 2]
    in_zone("Asia/Tokyo")
    assert loaded(spark, store, rows, load) == [1, 2, 3]
    assert loaded(spark, store, rows, load) == [1, 2, 3]


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(12,3)", "double", "date", "string", "timestamp_ntz"])
def test_marks_of_every_type(spark, store, kind):
    rows = spark.range(1, 7).select(F.col("id").cast("int").alias("id"), F.col("id").alias("n"))
    value = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id")) if kind in ("date", "string", "timestamp_ntz") else F.col("n")
    rows = rows.withColumn("v", value.cast(kind))
    load = LoadSpec("dbo", "t", "v", "", "incremental")
    assert loaded(spark, store, rows.where("id <= 2").unionByName(rows.where("id = 1").withColumn("v", F.lit(None).cast(kind))), load) == [1, 2]
    assert loaded(spark, store, rows, load) == [1, 2, 3, 4, 5, 6]
    assert loaded(spark, store, rows, load) == [1, 2, 3, 4, 5, 6]


def test_rows_equal_to_the_mark_come_by_key(spark, store):
    rows = spark.createDataFrame([(i, i // 4, "abcd"[i % 4]) for i in range(12)], "id int, v int, k string")
    load = LoadSpec("dbo", "t", "v", "", "incremental", ("k", "id"))
    assert loaded(spark, store, rows.where("id < 6"), load) == [*range(6)]
    assert store.mark("t") == ("1", ["b", "5"])
    assert loaded(spark, store, rows.where("id < 6"), load) == [*range(6)]
    assert loaded(spark, store, rows.where("id < 7"), load) == [*range(7)]
    assert loaded(spark, store, rows, load) == [*range(12)]
    # Without keys, rows equal to the mark stay out.
    plain = LoadSpec("dbo", "u", "v", "", "incremental")
    assert loaded(spark, store, rows.where("id < 6"), plain) == [*range(6)]
    assert loaded(spark, store, rows, plain) == [*range(6), *range(8, 12)]
