import pytest
from pyspark.sql import functions as F

from siltstone.functions.order import with_ranks
from siltstone.operators import cluster, skew
from siltstone.operators.conform import latest
from siltstone.operators.history import scd2


def test_finds_keys_above_a_fair_share(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    heavy, share, held = skew.heavy_keys(df, ["k"], floor=100)
    [hot] = spark.range(1).select(F.xxhash64(F.lit(-1).cast("bigint"))).first()
    assert [tuple(r) for r in heavy.collect()] == [(hot, 3000)] and share == 1125 and held == 3000


def test_very_many_hot_keys(spark):
    """More keys above a fair share than fit a list of a few thousand: all are found, all are cut."""
    df = spark.range(100_000).select((F.col("id") % 2500).alias("k"), F.col("id").alias("seq")).unionByName(
        spark.range(500).select((-F.col("id") - 1).alias("k"), F.col("id").alias("seq"))
    )
    spark.conf.set("spark.sql.shuffle.partitions", "3000")
    try:
        heavy, share, held = skew.heavy_keys(df, ["k"], floor=20)
        assert (heavy.count(), held) == (2500, 100_000) and share == 34
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    ordinary, heavy = skew.apart(df.where("k >= -5 AND k < 3"), ["k"], floor=20)
    assert ordinary.count() == 5 and heavy.select("k").distinct().count() == 3


def test_a_hot_key_with_dates_as_text(spark):
    day = F.concat(F.lit("calendar date: "), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 800).cast("int")).cast("string"))
    df = spark.range(8000).select(F.lit("hot").alias("k"), F.when(F.col("id") > 10, day).alias("seq"), (F.col("id") % 3).alias("v"))
    _, heavy = skew.split_heavy(df, ["k"], "seq", floor=500)
    per = heavy.groupBy(skew.SEGMENT).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n")).orderBy(skew.SEGMENT).collect()
    assert len(per) == 8 and max(r.n for r in per) < 2000
    assert all(a.hi < b.lo for a, b in zip(per, per[1:]))
    whole, cut = (scd2(df, ["k"], "seq", split_floor=floor) for floor in (None, 500))
    assert "_segment" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert whole.exceptAll(cut).count() == 0 == cut.exceptAll(whole).count()


def test_even_keys_are_left_alone(spark):
    df = spark.range(9000).withColumn("k", F.col("id") % 900)
    ordinary, heavy = skew.split_heavy(df, ["k"], "id", floor=100)
    assert heavy is None and ordinary is df


def test_segments_follow_the_sequence_and_share_the_rows(spark):
    df = spark.range(8000).select(F.lit("hot").alias("k"), (F.col("id") % 4000).alias("seq"))
    ordinary, heavy = skew.split_heavy(df, ["k"], "seq", floor=500)
    assert ordinary.count() == 0 and heavy.count() == 8000
    per = (
        heavy.groupBy(skew.SEGMENT).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n"))
        .orderBy(skew.SEGMENT).collect()
    )
    assert len(per) == 8 and max(r.n for r in per) < 2000
    assert all(a.hi < b.lo for a, b in zip(per, per[1:]))


def test_ranks_keep_order_for_every_kind(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, 1L, 1.5D, CAST(0.1 AS DECIMAL(10,2)), 'a',  DATE'2024-01-01', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-03-10 02:30:00.25', X'00'),
          (2, 2L, 2.5D, CAST(0.2 AS DECIMAL(10,2)), 'ab', DATE'2024-01-02', TIMESTAMP'2024-01-01 00:00:01', TIMESTAMP_NTZ'2024-03-10 02:30:00.75', X'0001'),
          (3, 3L, 3.5D, CAST(0.3 AS DECIMAL(10,2)), 'b',  DATE'2024-02-02', TIMESTAMP'2024-01-02 00:00:00', TIMESTAMP_NTZ'2024-03-10 03:00:00', X'01'),
          (4, 4L, 4.5D, CAST(0.4 AS DECIMAL(10,2)), 'zé', DATE'2025-01-01', TIMESTAMP'2025-01-01 00:00:00', TIMESTAMP_NTZ'2025-03-10 01:00:00', X'FF')
        AS t(i, l, d, m, s, dt, ts, ntz, x)""")
    names = {c: f"r_{c}" for c in df.columns}
    found = with_ranks(df, names, 4, 4).orderBy("i").collect()
    assert [[r[n] for n in names.values()] for r in found] == [[k] * 9 for k in range(4)]
    blank = df.select(*[F.when(F.col("i") > 1, F.col(c)).alias(c) for c in df.columns])
    for pieces in (1, 3, 5, 64):
        for r in with_ranks(blank, names, pieces, 4).where("i IS NULL").collect():
            assert {r[n] for n in names.values()} == {0}
    assert with_ranks(df.limit(0), names, 4, 0).count() == 0


def test_copies_of_a_key_collapse_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = latest(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1] and "WindowGroupLimit" in plan.split("Exchange")[1]


@pytest.fixture
def uncoalesced(spark):
    """Keeps small test partitions apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_zorder_keeps_rows_and_narrows_files(uncoalesced, tmp_path):
    spark = uncoalesced
    df = spark.range(20000).select(
        (F.xxhash64("id") % 1000).alias("a"),
        F.concat(F.lit("c"), (F.xxhash64("id", F.lit(1)) % 1000).cast("string")).alias("b"),
        "id",
    ).repartition(8, "id")
    z = cluster.zorder(df, ["a", "b"])
    assert z.exceptAll(df).count() == 0 and z.count() == 20000

    def span(frame, path):
        frame.write.parquet(path)
        files = spark.read.parquet(path).groupBy(F.input_file_name()).agg((F.max("a") - F.min("a")).alias("s"))
        return files.agg(F.avg("s")).first()[0]

    assert span(z, str(tmp_path / "z")) < 0.8 * span(df, str(tmp_path / "plain"))


def test_zorder_spreads_one_value(uncoalesced):
    df = uncoalesced.range(0, 40000, 1, 8).select(F.lit(5).alias("a"), F.lit("x").alias("b"), "id")
    sizes = cluster.zorder(df, ["a", "b"]).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 40000
    assert max(r["count"] for r in sizes) <= 10000


def test_clustering_finds_keys_behind_a_long_common_prefix(uncoalesced, tmp_path):
    df = uncoalesced.range(40000).select(
        F.concat(F.lit("a very long and common prefix/"), F.lpad((F.xxhash64("id") % 5000).cast("string"), 9, "0")).alias("a"),
        (F.xxhash64("id", F.lit(1)) % 5000).cast("decimal(12,2)").alias("b"),
    ).repartition(32)
    cluster.zorder(df, ["a", "b"], files=32).write.parquet(str(tmp_path / "z"))
    files = uncoalesced.read.parquet(str(tmp_path / "z")).groupBy(F.input_file_name()).agg(
        *[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))]
    ).collect()
    assert len(files) == 32
    for c in "ab":
        asked = [r[f"lo_{c}"] for r in files]
        held = [sum(r[f"lo_{c}"] <= key <= r[f"hi_{c}"] for r in files) for key in asked]
        assert sum(held) / len(held) <= 12, held
