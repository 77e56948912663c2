"""Each fact with the version of its key that was valid at the fact's own instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.columns import null_safe_join, require
from siltstone.operators.history import END, START
from siltstone.operators.skew import SEGMENT, SPLIT_FLOOR, split_heavy

_AT, _VERSION, _FACT = "_at", "_version", "_fact"


def _last(part: Sequence[str]) -> Column:
    """The last version at or before a row; versions come before facts of the same instant."""
    along = Window.partitionBy(*part).orderBy(_AT, F.col(_FACT).isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(_VERSION, ignorenulls=True).over(along)


def _cut(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` of heavy keys, matched range by range of the time.

    What a range begins with is the last version of the ranges before it: one row per key and range, found by
    an aggregate and carried along the ranges."""
    part = [*keys, SEGMENT]
    newest = rows.groupBy(*part).agg(F.max_by(_VERSION, F.when(F.col(_VERSION).isNotNull(), F.col(_AT))).alias("_newest"))
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(*part, F.last("_newest", ignorenulls=True).over(before).alias("_carried"))
    found = rows.withColumn(_VERSION, _last(part)).where(F.col(_FACT).isNotNull())
    return null_safe_join(found, carried, part, "left").withColumn(_VERSION, F.coalesce(_VERSION, "_carried")).drop("_carried", SEGMENT)


def asof_join(
    facts: DataFrame, history: DataFrame, on: Sequence[str | tuple[str, str]], at: str, how: str = "left",
    prefix: str = "", split_floor: int | None = SPLIT_FLOOR,
) -> DataFrame:
    """``facts`` with the columns of the version in ``history`` whose key equals theirs and that is valid at ``at``: it
    starts at or before that instant and ends after it, or not at all.

    ``on`` names key columns, or pairs of a fact's and the history's column.  Without a version the columns are
    NULL (``how="left"``) or the fact is left out (``"inner"``).  A NULL key or instant has no version, nor do
    versions without a start belong to any instant.  ``prefix`` goes before the names of the version's columns, which
    must not clash with those of the facts.

    Facts and versions of a key meet in one shuffle and one sort by time: no fact is paired with all versions of its
    key.  Keys too large for one task are cut into ranges of the time (``split_floor``, see ``scd2``).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    pairs = [(c, c) if isinstance(c, str) else c for c in on]
    require(facts, [*(f for f, _ in pairs), at], "asof_join")
    require(history, [*(h for _, h in pairs), START, END], "asof_join")
    keys = [f"_key{i}" for i in range(len(pairs))]
    given = [c for c in history.columns if c not in {h for _, h in pairs}]
    clash = {prefix + c for c in given} & set(facts.columns)
    if clash:
        raise ValueError(f"asof_join: both sides have {', '.join(sorted(clash))}")
    kind = history.schema[START].dataType
    fact = F.struct(*facts.columns)
    asked = facts.select(*[F.col(f).alias(k) for k, (f, _) in zip(keys, pairs)], F.col(at).cast(kind).alias(_AT), fact.alias(_FACT))
    findable = F.col(_AT).isNotNull()
    for k in keys:
        findable = findable & F.col(k).isNotNull()
    versions = history.select(
        *[F.col(h).alias(k) for k, (_, h) in zip(keys, pairs)], F.col(START).alias(_AT), F.struct(*given).alias(_VERSION)
    ).where(findable)
    rows = asked.where(findable).unionByName(versions, allowMissingColumns=True)
    ordinary, heavy = (rows, None) if split_floor is None else split_heavy(rows, keys, _AT, split_floor)
    found = ordinary.withColumn(_VERSION, _last(keys)).where(F.col(_FACT).isNotNull())
    if heavy is not None:
        found = found.unionByName(_cut(heavy, keys))
    ended = F.col(f"{_VERSION}.{END}") <= F.col(_AT)
    found = found.withColumn(_VERSION, F.when(~F.coalesce(ended, F.lit(False)), F.col(_VERSION)))
    if how == "inner":
        found = found.where(F.col(_VERSION).isNotNull())
    else:
        found = found.unionByName(asked.where(~findable), allowMissingColumns=True)
    return found.select(f"{_FACT}.*", *[F.col(_VERSION)[c].alias(prefix + c) for c in given])
