"""Z-order clustering: rows close in several columns land close together in files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import require
from siltstone.functions.order import interleave, with_ranks


ROWS_PER_FILE = 1_000_000
MOST_BITS = 12


def zorder(
    df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """The same rows, range-partitioned and sorted by the interleaved ranks of ``columns``, of any ordered types.

    Each column is cut into ranges of equal share, so many that all columns together tell eight times as many
    places apart as there are files (``files``, or rows by ``rows_per_file``); a column has 2**MOST_BITS ranges
    at most.  Inside one place the columns themselves order the rows, so however many rows share a place, files are
    cut by whole values.  ``within`` (the folder columns of a partitioned write) comes first.  The input partition
    number is the last range key, so one value held by very many rows still spreads over several tasks.

    ``df`` is read once to be counted, once for a sample, once for the range bounds and once for the rows; pass
    a written table, not an expensive query.
    """
    require(df, [*columns, *within], "zorder")
    rows = df.count()
    expected = files or max(1, math.ceil(rows / rows_per_file))
    bits = min(MOST_BITS, 62 // len(columns), math.ceil(math.log2(expected) / len(columns)) + 3)
    ranks = {c: f"_rank{i}" for i, c in enumerate(columns)}
    ranked = with_ranks(df, ranks, 2**bits, rows)
    code = interleave([F.col(r) for r in ranks.values()], bits)
    placed = ranked.withColumns({"_z": code, "_from": F.spark_partition_id()}).drop(*ranks.values())
    by = [*within, "_z", *columns, "_from"]
    spread = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return spread.sortWithinPartitions(*within, "_z", *columns).drop("_z", "_from")


def by_folder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gathers rows of the same folder before a partitioned write.  AQE sizes the output:
    small folders share a task, a folder with very many rows is split over several."""
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")
