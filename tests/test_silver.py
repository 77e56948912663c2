from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.operators import feed, prepare, quality
from siltstone.operators.conform import clean, conform, conversion_losses, latest
from siltstone.schemas import DIM_CUSTOMER, FACT_ORDER, FACT_ORDER_ITEM, INGESTED_AT, TableSpec


def raw_items(spark, *rows):
    return spark.createDataFrame(
        list(rows), "order_item_id string, order_id string, order_item_seq string, product_id string, "
        "seller_id string, shipping_limit_date string, price string, freight_value string"
    )


GOOD = ("1", "o1", "1", "p1", "s1", "2017-10-02 10:56:33", "58.90", "13.29")


def test_types_and_names(spark):
    out = conform(raw_items(spark, GOOD), FACT_ORDER_ITEM)
    assert out.columns == [*FACT_ORDER_ITEM.columns, INGESTED_AT]
    row = out.first()
    assert (row.order_item_id, row.order_item_seq, row.price) == (1, 1, Decimal("58.90"))
    assert row.shipping_limit_date == datetime(2017, 10, 2, 10, 56, 33)
    assert out.schema["price"].dataType.simpleString() == "decimal(10,2)"


def test_bad_values_become_null_and_are_counted(spark):
    bad = ("x", "o2", "1", "p1", "s1", "soon", "123456789012.00", None)
    df = raw_items(spark, GOOD, bad)
    row = conform(df, FACT_ORDER_ITEM).where("order_id = 'o2'").first()
    assert (row.order_item_id, row.shipping_limit_date, row.price, row.freight_value) == (None,) * 4
    losses = conversion_losses(df, FACT_ORDER_ITEM).first()
    assert (losses.order_item_id, losses.shipping_limit_date, losses.price, losses.freight_value) == (1, 1, 1, 0)


def test_strict_mode_fails(spark):
    bad = raw_items(spark, ("x", *GOOD[1:]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(bad, FACT_ORDER_ITEM, strict=True).collect()


def test_boolean_is_not_a_number(spark):
    df = raw_items(spark, GOOD).withColumn("price", F.lit(True))
    assert conform(df, FACT_ORDER_ITEM).first().price is None
    with pytest.raises(Exception, match="boolean cannot become"):
        conform(df, FACT_ORDER_ITEM, strict=True).collect()


def test_missing_column_is_null(spark):
    df = spark.createDataFrame([("o1",)], "order_id string")
    out = conform(df, FACT_ORDER, stamp=False)
    assert out.columns == list(FACT_ORDER.columns) and out.first().total_payment_value is None


def test_clean(spark):
    df = spark.createDataFrame(
        [(" c1 ", "u", 1, " sao paulo ", " sp"), (None, "u", 2, "x", "rj")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
    )
    [row] = clean(df, DIM_CUSTOMER).collect()
    assert (row.customer_id, row.customer_city, row.customer_state) == ("c1", "sao paulo", "SP")


def test_latest_prefers_known_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", None, "z")], "k string, n int, v string")
    assert {r.k: r.v for r in latest(df, ["k"], ["n"]).collect()} == {"a": "x", "b": "z"}


def items(spark):
    return spark.createDataFrame(
        [(1, Decimal("1.00")), (None, Decimal("1.00")), (2, Decimal("-1.00")), (3, None), (4, Decimal("0.00"))],
        "order_item_id long, price decimal(10,2)",
    )


def test_expectations(spark):
    rules = FACT_ORDER_ITEM.rules
    assert sorted(r.order_item_id for r in quality.expect(items(spark), rules).collect()) == [1, 4]
    kept = {r.order_item_id: r._failed for r in quality.expect(items(spark), rules, "keep").collect()}
    assert kept == {1: [], None: ["valid_order_item"], 2: ["valid_price"], 3: ["valid_price"], 4: []}
    counted = {r.rule: (r.passed, r.failed) for r in quality.counts(items(spark), rules).collect()}
    assert counted == {"valid_order_item": (4, 1), "valid_price": (3, 2)}
    with pytest.raises(Exception, match="expectation failed"):
        quality.expect(items(spark), rules, "fail").collect()
    assert quality.expect(items(spark).where("order_item_id in (1, 4)"), rules, "fail").count() == 2


def test_status_rule(spark):
    df = spark.createDataFrame([("shipped",), ("it's lost",), (None,)], "order_status string")
    assert quality.expect(df, {"s": quality.in_set("order_status", ["shipped", "it's lost"])}).count() == 2


def versions(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b int")


def test_change_kinds(spark):
    old = versions(spark, [(1, "x", 1), (2, "y", None), (3, "z", 3), (4, None, 4)])
    new = versions(spark, [(1, "x", 1), (2, "y", 2), (4, None, 4), (5, "n", 5)])
    got = {(r.k, r.b, r._change_type) for r in feed.change_feed(old, new, ["k"]).collect()}
    assert got == {(2, None, "update_preimage"), (2, 2, "update_postimage"), (3, 3, "delete"), (5, 5, "insert")}


def test_feed_leads_from_old_to_new_with_copies(spark):
    old = versions(spark, [(1, "x", 1)] * 3 + [(2, "y", 2), (None, "n", 0)])
    new = versions(spark, [(1, "x", 1)] * 5 + [(2, "y", 9), (3, "w", 3), (3, "w", 3)])
    changes = feed.change_feed(old, new, ["k"])
    after = feed.apply_feed(old, changes)
    assert after.exceptAll(new).count() == 0 and new.exceptAll(after).count() == 0
    assert feed.change_feed(new, new, ["k"]).count() == 0


def test_payment_rollup(spark):
    df = spark.createDataFrame(
        [("o", "voucher", 10), ("o", "credit_card", 10), ("o", "boleto", 3), ("p", "boleto", 1)],
        "order_id string, payment_type string, payment_value int",
    )
    got = {r.order_id: (r.total_payment_value, r.payment_type) for r in prepare.payment_rollup(df).collect()}
    assert got == {"o": (23, "voucher"), "p": (1, "boleto")}


def test_sample_by_date_takes_a_share_of_every_date(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-02-0"), F.col("id") % 9 + 1)).cast("date").alias("d")
    )
    total = {r.d: r["count"] for r in df.groupBy("d").count().collect()}
    for ranked in (1, 3, 10**6):
        sample = prepare.sample_by_date(df, "d", ["id"], 7, ranked=ranked)
        got = {r.d: r["count"] for r in sample.groupBy("d").count().collect()}
        assert got == {d: -(-n * 7 // 100) for d, n in total.items()}
    again = prepare.sample_by_date(df.repartition(3), "d", ["id"], 7)
    assert again.exceptAll(sample).count() == 0


def test_sample_keeps_copies_together_and_null_dates(spark):
    df = spark.range(50).selectExpr("id % 5 AS id", "CAST(NULL AS DATE) AS d")
    counts = prepare.sample_by_date(df, "d", ["id"], 30).groupBy("id").count().collect()
    assert [r["count"] for r in counts] == [10, 10]


def test_a_date_with_nearly_all_rows_is_refined_until_few_are_left(spark, monkeypatch):
    """Ranges are refined as deep as their counts ask for, and what is ranked in the end is small."""
    df = spark.range(40_000).withColumn("d", F.when(F.col("id") < 39_990, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date"))
    ranged = []
    real = prepare.measured
    monkeypatch.setattr(prepare, "measured", lambda rows: ranged.append(rows.agg(F.max("count")).first()[0] if "count" in rows.columns else None) or real(rows))
    sample = prepare.sample_by_date(df, "d", ["id"], 13, ranked=4)
    assert {str(r.d): r["count"] for r in sample.groupBy("d").count().collect()} == {"2024-01-01": 5199, "2024-01-02": 2}
    # Every round but the last names the rows of the range that is looked into next.
    assert ranged[0] > 4 and ranged[-2] <= 4 and ranged[-1] is None
    whole = prepare.sample_by_date(df, "d", ["id"], 13)
    assert whole.exceptAll(sample).count() == 0 == sample.exceptAll(whole).count()


def test_what_does_not_fit_is_kept_beside(spark):
    spec = TableSpec("t", {"k": None, "n": "int", "day": "timestamp", "gone": "int"}, keys=("k",))
    df = spark.createDataFrame([(1, "7", "2024-01-01"), (2, "7b", "soon"), (3, None, None)], "k int, n string, day string")
    got = {r.k: (r.n, r._rescued) for r in conform(df, spec, stamp=False, rescue=True).collect()}
    assert got == {1: (7, {}), 2: (None, {"n": "7b", "day": "soon"}), 3: (None, {})}


def test_random_sample_is_repeatable(spark):
    df = spark.range(10000)
    one, two = (prepare.sample_random(df, ["id"], 5).collect() for _ in range(2))
    assert one == two and 400 < len(one) < 600
    assert one != prepare.sample_random(df, ["id"], 5, seed=1).collect()


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 28, 5),), (datetime(2024, 3, 1),)], "t timestamp")
    rows = prepare.dim_date(df, "t").collect()
    assert [r.date_key for r in rows] == [20240228, 20240229, 20240301]
    assert rows[1].day_name == "Thursday" and rows[1].day_of_week == 4 and not rows[1].is_weekend
    assert prepare.dim_date(df.where("false"), "t").count() == 0


def test_missing_key_or_strict_column_is_an_error(spark):
    df = spark.createDataFrame([("c1",)], "customer_id string")
    with pytest.raises(ValueError, match="order_id"):
        conform(df, FACT_ORDER)
    with pytest.raises(ValueError, match="customer_id"):
        conform(spark.createDataFrame([("o1",)], "order_id string"), FACT_ORDER, strict=True)


def test_small_percentages_are_exact(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    assert 500 < prepare.sample_random(df, ["k"], 0.29).count() < 660
    assert prepare.sample_random(df, ["k"], 0.005).count() > 0
    assert prepare._share(0.29) == (29, 10_000) and prepare._share(0.005) == (5, 100_000)
