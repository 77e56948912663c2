"""Find keys too large for one task and cut their rows into ranges of the sequence."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.order import with_ranks
from siltstone.session import saved

SEGMENT = "_segment"

# A key below this many rows is never split: sorting it in one task is cheap.
SPLIT_FLOOR = 2_000_000

# Sketches are merged in this many groups at most, so no task merges those of all tasks.
SKETCH_GROUPS = 200
# Most shares that rows are counted in: a share is a part of this size of all rows, or a larger one on fewer partitions.
# At most so many keys can exceed a share, so their hashes (16 bytes each) are a table of bounded size.
SHARES = 100_000


def heavy_keys(df: DataFrame, keys: Sequence[str], floor: int = SPLIT_FLOOR) -> tuple[DataFrame | None, int, int]:
    """``h, n``: hash and row count of the keys that hold more than a fair share; that share; the rows they hold.
    Without such a key the table is None.

    One narrow pass: each task keeps a frequent-items sketch of fixed size, sketches are merged
    group by group, and the groups' top lists are summed.  The keys stay a table; the driver gets two numbers.
    What is found decides only how rows are spread; results do not depend on it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = max(1, min(parts, SHARES))
    top = F.expr(f"approx_top_k(h, {k}, {max(4096, 8 * k)})")
    rows = df.select(F.xxhash64(*keys).alias("h"), (F.spark_partition_id() % min(parts, SKETCH_GROUPS)).alias("g"))
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), top.alias("top"))
    # The row count travels as an item without a key.
    total = F.struct(F.lit(None).cast("bigint").alias("item"), F.col("n").alias("count"))
    items = groups.select(F.inline(F.array_append("top", total))).groupBy("item").agg(F.sum("count").alias("n"))
    total, most = items.agg(F.sum(F.when(F.col("item").isNull(), F.col("n"))), F.max(F.when(F.col("item").isNotNull(), F.col("n")))).first()
    share = max(floor, math.ceil((total or 0) / k))
    if (most or 0) <= share:
        return None, share, 0
    found = saved(items.where("item IS NOT NULL").where(F.col("n") > share).select(F.col("item").alias("h"), "n"))
    return found, share, found.agg(F.sum("n")).first()[0]


def _having(df: DataFrame, keys: Sequence[str], heavy: DataFrame, how: str) -> DataFrame:
    """The rows whose key is (``left_semi``) or is not (``left_anti``) among ``heavy``, a table of SHARES rows at most."""
    return df.join(F.broadcast(heavy.select(F.col("h").alias("_heavy"))), F.xxhash64(*keys) == F.col("_heavy"), how)


def split_heavy(
    df: DataFrame, keys: Sequence[str], sequence: str, floor: int = SPLIT_FLOOR
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of heavy keys with a ``_segment`` number or None).

    Segments are ranges of the sequence that hold about a fair share of the heavy rows each, cut at values of its own
    type, text included.  Equal sequence values fall into the same segment, and segment order is sequence order.
    """
    heavy, share, held = heavy_keys(df, keys, floor)
    if heavy is None:
        return df, None
    pieces = max(2, math.ceil(held / share))
    rows = with_ranks(_having(df, keys, heavy, "left_semi"), {sequence: SEGMENT}, pieces, held)
    return _having(df, keys, heavy, "left_anti"), rows


def apart(df: DataFrame, keys: Sequence[str], floor: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of heavy keys or None)."""
    heavy, _, _ = heavy_keys(df, keys, floor)
    if heavy is None:
        return df, None
    return _having(df, keys, heavy, "left_anti"), _having(df, keys, heavy, "left_semi")
