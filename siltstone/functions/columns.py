"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def holds(predicate: str | Column) -> Column:
    """TRUE only where the predicate is TRUE: an unknown outcome counts as a failure."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(condition, F.lit(False))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join where NULL keys match each other; the result keeps the left side's key columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{c}" for c in on])


def require(df: DataFrame, names: Sequence[str], where: str) -> None:
    """Identifiers from metadata must name real columns before they enter a plan."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{where}: no column {', '.join(missing)}")
