"""Preparing source tables: samples, payment roll-up, calendar."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.columns import null_safe_join
from siltstone.functions.order import hash60
from siltstone.session import measured, saved


def _share(percent: float) -> tuple[int, int]:
    """``percent`` as an exact fraction (part, whole), however small; whole is 10,000 at least."""
    given = Decimal(str(percent))
    scale = max(2, -given.as_tuple().exponent)
    return int(given.scaleb(scale)), 10 ** (scale + 2)


def sample_random(df: DataFrame, keys: Sequence[str], percent: float, seed: int = 0) -> DataFrame:
    """About ``percent`` of the keys with all their rows; the same keys on every run.  No shuffle."""
    part, whole = _share(percent)
    return df.where(hash60(keys, seed) % whole < part)


# A range of hashes with at most so many rows of a date is ranked row by row.
RANKED = 100_000
_DIGIT = 12  # bits by which a range is refined at a time


def sample_by_date(
    df: DataFrame, date: str, keys: Sequence[str], percent: float, grain: str = "day", seed: int = 0, ranked: int = RANKED
) -> DataFrame:
    """``percent`` of the rows of every date (rounded up), so the date distribution is kept.

    Within a date the rows with the smallest key hashes are taken; rows of one key stay together.  The limit of a
    date is found by radix selection: rows are counted per range of hashes, the range that the limit falls into is
    refined by further bits, and so on until it has at most ``ranked`` rows or is a single hash.  How deep that goes
    follows from the counts.  So no task ever ranks the rows of a whole date, and the table itself is not shuffled.
    """
    rows = df.withColumns({"_date": F.date_trunc(grain, date), "_hash": hash60(keys, seed)})
    narrow = rows.select("_date", "_hash")
    part, whole = _share(percent)

    def reach(counts: DataFrame) -> DataFrame:
        """Per date the range at which the running count reaches what is needed, and what is needed inside it."""
        running = Window.partitionBy("_date").orderBy("_range")
        counts = counts.withColumn("_upto", F.sum("count").over(running))
        within = counts.where((F.col("_upto") - F.col("count") < F.col("_need")) & (F.col("_need") <= F.col("_upto")))
        return within.select("_date", "_range", (F.col("_need") - (F.col("_upto") - F.col("count"))).alias("_need"), "count")

    shift = 60 - _DIGIT
    counts = narrow.groupBy("_date", F.shiftright("_hash", shift).alias("_range")).count()
    total = F.sum("count").over(Window.partitionBy("_date"))
    # Integer arithmetic: ceil(total * percent / 100) without rounding surprises.
    counts = counts.withColumn("_need", F.floor((total * part + whole - 1) / whole).cast("bigint"))
    while True:
        edge = saved(reach(counts))
        most = edge.agg(F.max("count")).first()[0] or 0
        if not shift:
            break
        own = null_safe_join(
            narrow.withColumn("_range", F.shiftright("_hash", shift)), measured(edge).drop("count"), ["_date", "_range"], "inner"
        )
        shift = max(0, shift - _DIGIT) if most > ranked else 0
        counts = own.groupBy("_date", "_need", F.shiftright("_hash", shift).alias("_range")).count()
    limit = edge.select("_date", F.col("_range").alias("_limit"))
    return null_safe_join(rows, measured(limit), ["_date"], "inner").where("_hash <= _limit").select(*df.columns)


def payment_rollup(
    payments: DataFrame, order: str = "order_id", value: str = "payment_value", kind: str = "payment_type"
) -> DataFrame:
    """One row per order: the sum paid and the type of the largest payment (ties by type name)."""
    return payments.groupBy(order).agg(
        F.sum(value).alias("total_payment_value"),
        F.max_by(kind, F.struct(value, kind)).alias(kind),
    )


def dim_date(df: DataFrame, date: str) -> DataFrame:
    """The calendar from the first to the last ``date`` of a table, one row per day."""
    ends = df.agg(F.to_date(F.min(date)).alias("lo"), F.to_date(F.max(date)).alias("hi")).where("lo IS NOT NULL")
    day = F.col("date")
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
