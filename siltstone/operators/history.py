"""Slowly changing history: type 1, type 2, current and as-of views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.columns import holds, null_safe_join, require
from siltstone.functions.order import last_resort
from siltstone.operators.conform import latest
from siltstone.operators.skew import SEGMENT, SPLIT_FLOOR, apart, split_heavy
from siltstone.session import saved

START, END, DELETED = "__START_AT", "__END_AT", "__DELETED"
HEAD = "_head"


def _runs(
    rows: DataFrame, parts: Sequence[str], sequence: str, ties: Sequence[str], state: Sequence[str],
    carried: Sequence[str],
) -> DataFrame:
    """One row per run of equal ``state`` along the sequence inside each of ``parts``.

    All windows share one partitioning and one sort, so this is a single shuffle and a single
    sort.  ``_head`` marks the first run of a part; the last one has no end.
    """
    by_tie = Window.partitionBy(*parts).orderBy(sequence, *ties, *last_resort(rows, [*parts, sequence, *ties]))
    along = Window.partitionBy(*parts).orderBy(sequence)
    value = F.struct(*state)

    def differs(other: str) -> Column:
        # NULL-safe: NULL against a value is a change, NULL against NULL is none.
        return F.col(other).isNull() | ~F.col(other).eqNullSafe(value)

    # Structs from a neighbouring row are NULL only where there is no such row.
    # Of rows equal in key and sequence the last by tie-breaker counts.
    rows = rows.withColumn("_next", F.lead(F.struct(sequence)).over(by_tie))
    rows = rows.where(F.col("_next").isNull() | ~F.col(f"_next.{sequence}").eqNullSafe(F.col(sequence)))

    # Columns outside the tracked set keep the value of the run's last row, so both ends of a
    # run stay and the first then looks at the one after it.
    rows = rows.withColumn("_previous", F.lag(value).over(along))
    if carried:
        rows = rows.withColumn("_next", F.lead(value).over(along))
    rows = rows.withColumns({"_opens": differs("_previous"), "_closes": differs("_next") if carried else F.lit(False)})
    rows = rows.where("_opens OR _closes")
    if carried:
        rows = rows.withColumn("_last", F.lead(F.struct(*carried)).over(along)).where("_opens")
        rows = rows.withColumns(
            {c: F.when(F.col("_closes"), F.col(c)).otherwise(F.col(f"_last.{c}")) for c in carried}
        )
    runs = rows.withColumns({HEAD: F.col("_previous").isNull(), END: F.lead(sequence).over(along)})
    return runs.withColumn(START, F.col(sequence)).drop("_previous", "_next", "_last", "_opens", "_closes")


def _joined(runs: DataFrame, keys: Sequence[str], state: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Runs found segment by segment as runs of the whole key.

    Only the outer runs of a segment can change: its first is no new version when the segment
    before ended in the same state, and its last ends where the next version opens.  There are
    at most two such rows per key and segment; all others pass as they are.
    """
    parts = [*keys, SEGMENT]
    is_outer = F.col(HEAD) | F.col(END).isNull()
    outer = runs.where(is_outer)
    head = F.struct(F.struct(*state).alias("state"), START, END, F.struct(*carried, F.lit(0).alias("_")).alias("carried"))
    along = Window.partitionBy(*keys).orderBy(SEGMENT)
    after = Window.partitionBy(*keys).orderBy(F.desc(SEGMENT))
    segments = outer.groupBy(*parts).agg(
        F.first(F.when(F.col(HEAD), head), ignorenulls=True).alias("h"),
        F.first(F.when(F.col(END).isNull(), F.struct(*state)), ignorenulls=True).alias("tail"),
    )
    before = F.lag("tail").over(along)
    segments = segments.withColumns(
        {
            "_opens": before.isNull() | ~before.eqNullSafe(F.col("h.state")),
            "_inner": F.lag(F.col(f"h.{END}").isNotNull()).over(along),
        }
    )
    # Segments one run passes through form a chain; its last segment has the run's last row.
    segments = segments.withColumns(
        {
            "_chain": F.sum((F.col("_opens") | F.coalesce("_inner", F.lit(False))).cast("int")).over(along),
            "_first": F.when(F.col("_opens"), F.col(f"h.{START}")).otherwise(F.col(f"h.{END}")),
        }
    )
    chain = Window.partitionBy(*keys, "_chain").orderBy(F.desc(SEGMENT)).rowsBetween(Window.unboundedPreceding, 0)
    segments = segments.withColumns(
        {
            "_until": F.last("_first", ignorenulls=True).over(after.rowsBetween(Window.unboundedPreceding, -1)),
            "_final": F.when(~F.col("_opens"), F.first("h.carried").over(chain)),
        }
    ).withColumn("_final", F.lead("_final").over(along))
    fixed = null_safe_join(outer, segments.select(*parts, "_opens", "_until", "_final"), parts, "inner")
    fixed = fixed.where(~F.col(HEAD) | F.col("_opens"))
    goes_on = F.col(END).isNull() & F.col("_final").isNotNull()
    fixed = fixed.withColumns(
        {
            **{c: F.when(goes_on, F.col(f"_final.{c}")).otherwise(F.col(c)) for c in carried},
            END: F.coalesce(END, "_until"),
        }
    )
    return runs.where(~is_outer).unionByName(fixed.select(*runs.columns))


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    ties: Sequence[str] = (),
    deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    tracked: Sequence[str] | None = None,
    keep_deletes: bool = False,
    split_floor: int | None = SPLIT_FLOOR,
) -> DataFrame:
    """Type 2 history of a change feed: one row per key version, valid in [start, end).

    The order of arrival plays no part, only ``sequence``; ``ties`` decides between rows equal
    in key and sequence, and between rows equal in these too their own values do, column by column in the order
    of their names.  A row matching ``deletes`` closes the version before it and opens
    none; with ``keep_deletes`` it stays as a row flagged ``__DELETED``.  With ``tracked`` only
    those columns open a version and the others are updated in place; naming ``sequence`` there
    makes every new sequence value a version.

    One extra pass over the key columns looks for keys too large for one task (more rows than
    ``split_floor`` and than a fair share); ``split_floor=None`` skips it.
    """
    require(df, [*keys, sequence, *ties, *except_columns, *(tracked or ())], "scd2")
    kept = [c for c in df.columns if c not in except_columns]
    rows = df.withColumn(DELETED, holds(deletes) if deletes is not None else F.lit(False))
    rows = rows.select(*dict.fromkeys([*kept, *keys, sequence, *ties, DELETED]))

    values = [c for c in kept if c not in keys and (c != sequence or c in (tracked or ()))]
    state = [DELETED, *(c for c in values if tracked is None or c in tracked)]
    carried = [c for c in values if c not in state]
    args = (sequence, list(ties), state, carried)

    ordinary, heavy = (rows, None) if split_floor is None else split_heavy(rows, keys, sequence, split_floor)
    history = _runs(ordinary, keys, *args)
    wanted = [*kept, START, END, *([DELETED] if keep_deletes else [])]
    visible = F.lit(True) if keep_deletes else ~F.col(DELETED)
    history = history.where(visible).select(*wanted)
    if heavy is not None:
        heavy = _without_copies(heavy, [*keys, sequence], ties, split_floor)
        runs = saved(_runs(heavy, [*keys, SEGMENT], *args))
        history = history.unionByName(_joined(runs, keys, state, carried).where(visible).select(*wanted))
    return history


def _without_copies(rows: DataFrame, change: list[str], ties: Sequence[str], floor: int) -> DataFrame:
    """``rows`` where a change repeated very many times has collapsed on the map side, since no
    cut of the sequence can spread it.  Other repeats are left to the windows."""
    ordinary, repeated = apart(rows, change, floor)
    return rows if repeated is None else ordinary.unionByName(latest(repeated, change, ties))


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    ties: Sequence[str] = (),
    deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    keep_deletes: bool = False,
) -> DataFrame:
    """Type 1 table: the newest row of each key; keys whose newest row is a delete are absent,
    or kept as ``__DELETED`` rows with ``keep_deletes``."""
    flagged = df.withColumn(DELETED, holds(deletes) if deletes is not None else F.lit(False))
    newest = latest(flagged, keys, [sequence, *ties], except_columns).drop(*except_columns)
    return newest if keep_deletes else newest.where(~F.col(DELETED)).drop(DELETED)


def current(history: DataFrame) -> DataFrame:
    """The open version of every key."""
    return history.where(F.col(END).isNull())


def as_of(history: DataFrame, instant) -> DataFrame:
    """The versions valid at ``instant`` (a literal of the sequence type, or its text)."""
    at = F.lit(instant).cast(history.schema[START].dataType)
    return history.where((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))
