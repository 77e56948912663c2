import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators.history import current, scd1, scd2
from siltstone.operators.quality import expect
from siltstone.schemas import DIM_CUSTOMER, FACT_ORDER_ITEM, INGESTED_AT
from siltstone.sources.store import LoadStore
from siltstone.streaming.changes import ChangeTarget
from siltstone.streaming.files import file_stream, finish, start_append, start_silver
from siltstone.streaming.loads import start_conform

CUSTOMER = "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string, updated_at string"


def customers(spark, *rows):
    return spark.createDataFrame([(k, f"u{k}", 1, city, "SP", t) for k, city, t in rows], CUSTOMER)


def test_file_stream_reads_each_file_once(spark, tmp_path):
    bronze, silver, check = (str(tmp_path / n) for n in ("bronze", "silver", "check"))
    customers(spark, ("a", "x", "2024-01-01 00:00:00")).write.parquet(bronze)
    schema = spark.read.parquet(bronze).schema

    def run():
        finish(start_silver(spark, DIM_CUSTOMER, bronze, schema, silver, check))
        return spark.read.parquet(silver)

    first = run()
    assert first.columns == [*DIM_CUSTOMER.columns, INGESTED_AT]
    assert first.first().updated_at == datetime(2024, 1, 1)
    customers(spark, ("b", "y", "bad date")).write.mode("append").parquet(bronze)
    assert run().count() == 2
    assert run().where("updated_at IS NULL").count() == 1


def test_streams_run_side_by_side_into_tables(spark, tmp_path):
    queries = []
    for name in ("one", "two"):
        src = str(tmp_path / name)
        spark.range(3).write.parquet(src)
        stream = file_stream(spark, src, spark.range(1).schema, max_files=1)
        queries.append(start_append(stream, str(tmp_path / f"{name}_out"), str(tmp_path / f"{name}_c"), f"silver_{name}"))
    finish(*queries)
    assert spark.table("silver_one").count() == spark.table("silver_two").count() == 3


def test_a_failing_stream_is_reported(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(src)
    bad = expect(file_stream(spark, src, spark.range(1).schema), {"none": "id > 5"}, "fail")
    with pytest.raises(Exception, match="expectation failed"):
        finish(start_append(bad, str(tmp_path / "out"), str(tmp_path / "c")))


def test_committed_loads_reach_silver_once(spark, tmp_path):
    bronze, silver = LoadStore(spark, str(tmp_path / "b")), LoadStore(spark, str(tmp_path / "s"))

    def run():
        finish(start_conform(bronze, silver, DIM_CUSTOMER, str(tmp_path / "c")))
        return sorted(r.customer_id for r in silver.read("DimCustomer").collect())

    bronze.put(customers(spark, ("a", "x", "2024-01-01 00:00:00")), "DimCustomer")
    assert run() == ["a"]
    bronze.write(customers(spark, ("b", "x", "2024-01-02 00:00:00")), "DimCustomer", "crashed")
    assert run() == ["a"]
    bronze.put(customers(spark, ("b", "x", "2024-01-02 00:00:00"), ("d", "x", "soon")), "DimCustomer")
    bronze.put(customers(spark, ("c", "x", "2024-01-03 00:00:00")), "DimCustomer")
    assert run() == ["a", "b", "c", "d"]
    assert run() == ["a", "b", "c", "d"]
    assert [load.counts for load in silver.visible("DimCustomer")] == [{"updated_at": 0}, {"updated_at": 1}]


def test_full_reload_replaces_silver(spark, tmp_path):
    bronze, silver = LoadStore(spark, str(tmp_path / "b")), LoadStore(spark, str(tmp_path / "s"))
    items = spark.createDataFrame(
        [(1, "o", 1, "p", "s", "2024-01-01 00:00:00", "5.00", "1.00"), (2, "o", 2, "p", "s", "2024-01-01 00:00:00", "-5.00", "1.00")],
        "order_item_id int, order_id string, order_item_seq int, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string",
    )

    def run():
        finish(start_conform(
            bronze, silver, FACT_ORDER_ITEM, str(tmp_path / "c"),
            transform=lambda df: expect(df.drop(INGESTED_AT), FACT_ORDER_ITEM.rules),
        ))
        return silver.read("FactOrderItem")

    for _ in range(2):
        bronze.put(items, "FactOrderItem", strategy="full")
        assert [r.order_item_id for r in run().collect()] == [1]
    assert INGESTED_AT not in run().columns


# -- change targets ------------------------------------------------------------------------

T0 = datetime(2024, 1, 1)
FEED = "k string, seq timestamp_ntz, id int, a string, b string, op string"


def changes(n=600, seed=1):
    rng = random.Random(seed)
    return [
        (f"k{rng.randrange(25)}", T0 + timedelta(hours=rng.randrange(200)), i, rng.choice(["p", "q", None]), rng.choice("uv"), rng.choice("IIID"))
        for i in range(n)
    ]


def target(spark, root, **options):
    options = dict(deletes="op = 'D'", except_columns=("id", "op"), buckets=4) | options
    return ChangeTarget(LoadStore(spark, str(root)), "t", ("k",), "seq", ("id",), **options)


def same(a, b):
    assert a.columns == b.columns
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("tracked", [None, ("a",)])
def test_any_split_gives_the_batch_history(spark, tmp_path, tracked):
    rows = changes()
    whole = scd2(
        spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"], tracked=tracked
    )
    t = target(spark, tmp_path, tracked=tracked, split_floor=50)
    for batch, part in enumerate((rows[400:], rows[:150], rows[100:450])):  # out of order and overlapping
        t.apply(spark.createDataFrame(part, FEED), batch)
    assert same(t.table(), whole)


def test_ordered_batches_only_append_closed_versions(spark, tmp_path):
    rows = sorted(changes(400, seed=6), key=lambda r: r[1])
    cuts = [0] + [next(i for i, r in enumerate(rows) if r[1] >= T0 + timedelta(hours=h)) for h in (60, 120)] + [len(rows)]
    whole = scd2(spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    t = target(spark, tmp_path)
    for batch, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        t.apply(spark.createDataFrame(rows[lo:hi], FEED), batch)
    assert all(load.counts["late_keys"] == 0 for load in t.store.visible("t"))
    assert same(t.table(), whole) and same(t.current(), current(whole))
    assert "PartitionFilters: [isnotnull(_open" in t.current()._jdf.queryExecution().executedPlan().toString()
    # One late change rebuilds its own key and no other.
    late = ("k3", T0, 10_000, "q", "v", "I")
    t.apply(spark.createDataFrame([late], FEED), 3)
    last = t.store.visible("t")[-1]
    assert last.counts["late_keys"] == 1
    assert {r.k for r in t.store.read("t", [last]).collect()} == {"k3"}
    whole = scd2(spark.createDataFrame([*rows, late], FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    assert same(t.table(), whole)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_batch_writes_the_keys_it_changes(spark, tmp_path, scd_type):
    rows = changes(2000, seed=11) + [(f"n{i}", T0, i, "p", "u", "I") for i in range(500)]
    t = target(spark, tmp_path, scd_type=scd_type)
    t.apply(spark.createDataFrame(rows, FEED), 0)
    before = sorted(map(str, t.table().collect()))
    # Repeats, wherever they lie in the history of their key, write nothing and are not kept.
    repeats = rows[::50]
    assert len(repeats) >= 40
    t.apply(spark.createDataFrame(repeats, FEED), 1)
    assert [load.rows for load in t.store.visible("t")][1:] == []
    assert sum(load.rows for load in t.store.visible(t.log)[1:]) == 0
    assert sorted(map(str, t.table().collect())) == before
    new = [(f"new{i}", T0, 10_000 + i, "p", "u", "I") for i in range(5)]
    t.apply(spark.createDataFrame(new + repeats, FEED), 2)
    assert [load.rows for load in t.store.visible("t")][1:] == [5]
    # A later change of one key: its old version closed and its new one.
    t.apply(spark.createDataFrame([("n7", T0 + timedelta(days=99), 1, "q", "u", "I")], FEED), 3)
    assert t.store.visible("t")[-1].rows == scd_type


def test_versions_that_vanish_come_back(spark, tmp_path):
    """A version that a late change removed, and that opens and closes again later."""
    step = lambda h, i, a: ("x", T0 + timedelta(hours=h), i, a, "u", "I")
    parts = [[step(1, 1, "p"), step(3, 1, "q"), step(5, 1, "p")], [step(3, 2, "p")], [step(3, 3, "q")], [step(7, 1, "r"), step(4, 1, "q")], [step(8, 1, None)]]
    t = target(spark, tmp_path, fold_after=100)
    seen = []
    for batch, part in enumerate(parts):
        seen += part
        t.apply(spark.createDataFrame(part, FEED), batch)
        whole = scd2(spark.createDataFrame(seen, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
        assert same(t.table(), whole) and same(t.current(), current(whole))
    target(spark, tmp_path, fold_after=100, cluster_by=("a", "b")).fold()
    assert same(t.table(), whole) and len(t.store.visible("t")) == 1


def test_null_sequences_and_null_keys_in_batches(spark, tmp_path):
    rows = [(None, None, 1, "p", "u", "I"), ("x", None, 2, "p", "u", "I"), (None, T0, 3, "q", "u", "I"), ("x", T0, 4, "q", "u", "I"), ("x", None, 5, "r", "u", "I")]
    t = target(spark, tmp_path)
    for batch, part in enumerate((rows[:2], rows[2:4], rows[4:], rows)):
        t.apply(spark.createDataFrame(part, FEED), batch)
    whole = scd2(spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    assert same(t.table(), whole)


def test_the_number_of_buckets_is_kept(spark, tmp_path):
    t = target(spark, tmp_path, buckets=4)
    t.apply(spark.createDataFrame(changes(50), FEED), 0)
    with pytest.raises(ValueError, match="stored in 4 buckets, not 7"):
        target(spark, tmp_path, buckets=7).apply(spark.createDataFrame(changes(50), FEED), 1)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_column_added_later_makes_no_repeat_new(spark, tmp_path, scd_type):
    t = target(spark, tmp_path, scd_type=scd_type)
    rows = spark.createDataFrame(changes(60), FEED)
    t.apply(rows, 0)
    t.apply(rows.withColumn("c", F.lit(None).cast("string")), 1)
    assert len(t.store.visible("t")) == 1
    t.apply(rows.withColumn("c", F.lit("x")).limit(3), 2)
    assert t.table().where("c IS NOT NULL").count() > 0 or scd_type == 1


@pytest.mark.parametrize("scd_type", [1, 2])
def test_rows_equal_in_sequence_and_ties(spark, tmp_path, scd_type):
    """The rows themselves decide, whatever the order, the split and the kind of job."""
    rows = [(f"k{i % 7}", T0 + timedelta(hours=i % 3), 1, "pqr"[(i * i) % 3], "uvw"[(i * 5) % 3], "IID"[i % 11 % 3]) for i in range(200)]
    batch = scd2 if scd_type == 2 else scd1
    kept = [c for c in ("k", "seq", "a", "b")]
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, FEED).repartition(3 + seed)
        whole = batch(df, ["k"], "seq", deletes="op = 'D'", except_columns=["id", "op"])
        want = whole if want is None else want
        assert same(whole, want) and set(kept) <= set(whole.columns)
        t = ChangeTarget(LoadStore(spark, str(tmp_path / str(seed))), "t", ("k",), "seq", deletes="op = 'D'", except_columns=("id", "op"), scd_type=scd_type, buckets=4)
        for number in range(3):
            t.apply(spark.createDataFrame(rows[number * 70 : number * 70 + 70], FEED), number)
        assert same(t.table(), want)


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    rows = changes(100)
    t = target(spark, tmp_path)
    t.apply(spark.createDataFrame(rows, FEED), 0)
    before = t.table().collect()
    t.apply(spark.createDataFrame(rows, FEED), 0)
    assert sorted(map(str, t.table().collect())) == sorted(map(str, before))
    assert t.store.ledger("t").count() == 1


def test_a_crash_between_log_and_history_is_made_good(spark, tmp_path, monkeypatch):
    rows = changes(200)
    whole = scd2(spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    t = target(spark, tmp_path)
    t.apply(spark.createDataFrame(rows[:100], FEED), 0)
    before = sorted(map(str, t.table().collect()))
    with monkeypatch.context() as m:
        m.setattr(ChangeTarget, "_versions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.apply(spark.createDataFrame(rows[100:], FEED), 1)
    assert sorted(map(str, t.table().collect())) == before
    t.apply(spark.createDataFrame(rows[100:], FEED), 1)
    assert same(t.table(), whole)


def test_folding_the_log_keeps_the_history(spark, tmp_path):
    rows = changes(400, seed=4)
    whole = scd2(spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    t = target(spark, tmp_path, fold_after=2)
    for batch in range(5):
        t.apply(spark.createDataFrame(rows[batch * 80:(batch + 1) * 80], FEED), batch)
    assert len(t.store.visible(t.log)) <= 2
    assert same(t.table(), whole)
    t.store.vacuum("t", older_than_hours=-1)
    t.store.vacuum(t.log, older_than_hours=-1)
    assert same(t.table(), whole)


def test_a_key_deleted_to_nothing_disappears(spark, tmp_path):
    t = target(spark, tmp_path)
    t.apply(spark.createDataFrame([("x", T0 + timedelta(hours=5), 1, "p", "u", "I")], FEED), 0)
    assert t.table().count() == 1
    t.apply(spark.createDataFrame([("x", T0 + timedelta(hours=1), 2, "p", "u", "I"), ("x", T0 + timedelta(hours=5), 3, "p", "u", "D")], FEED), 1)
    [row] = t.table().collect()
    assert row["__END_AT"] == T0 + timedelta(hours=5)
    t.apply(spark.createDataFrame([], FEED), 2)
    assert t.table().count() == 1


def test_type_1_target(spark, tmp_path):
    rows = changes(300, seed=8)
    whole = scd1(spark.createDataFrame(rows, FEED), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    t = target(spark, tmp_path, scd_type=1)
    for batch, part in enumerate((rows[200:], rows[:120], rows[120:200])):
        t.apply(spark.createDataFrame(part, FEED), batch)
    assert same(t.table(), whole)


def test_stream_over_files_in_several_batches(spark, tmp_path):
    rows = changes(300, seed=2)
    src = str(tmp_path / "src")
    for i in range(3):
        spark.createDataFrame(rows[i::3], FEED).coalesce(1).write.mode("append").parquet(src)
    t = target(spark, tmp_path / "t")
    stream = file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    finish(t.start(stream, str(tmp_path / "c")))
    whole = scd2(spark.read.parquet(src), ["k"], "seq", ["id"], deletes="op = 'D'", except_columns=["id", "op"])
    assert t.store.ledger("t").count() == 3 and same(t.table(), whole)


def test_the_feed_of_a_history(spark, tmp_path):
    """A repeat changes nothing, a delete is one, and no bookkeeping column is shown."""
    hour = lambda h: T0 + timedelta(hours=h)
    t = target(spark, tmp_path)
    first = [("x", hour(1), 1, "p", "u", "I"), ("x", hour(3), 2, "q", "u", "I"), ("y", hour(2), 3, "p", "u", "I")]
    t.apply(spark.createDataFrame(first, FEED), 0)
    t.apply(spark.createDataFrame([first[1], ("x", hour(5), 4, "q", "u", "I"), ("y", hour(4), 5, "p", "u", "D"), ("z", hour(6), 6, None, None, "I")], FEED), 1)
    feed = t.changes()
    assert feed.columns == ["k", "seq", "a", "b", "_changed_at", "_change_type"]
    got = sorted((r["k"], r["_changed_at"], r["_change_type"], r["a"]) for r in feed.collect())
    assert got == [
        ("x", hour(1), "insert", "p"), ("x", hour(3), "update_postimage", "q"), ("x", hour(3), "update_preimage", "p"),
        ("y", hour(2), "insert", "p"), ("y", hour(4), "delete", "p"), ("z", hour(6), "insert", None),
    ]
    part = t.changes(since=str(hour(2)), until=str(hour(4)))
    assert sorted((r["k"], r["_change_type"]) for r in part.collect()) == [("x", "update_postimage"), ("x", "update_preimage"), ("y", "delete")]
