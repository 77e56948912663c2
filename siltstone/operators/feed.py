"""Row-level change set between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.columns import require
from siltstone.operators.history import END, START
from siltstone.sources.store import LoadStore

CHANGE = "_change_type"


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ, with ``_change_type`` insert, delete, update_preimage or update_postimage.

    ``keys`` identifies a row within each version.  Rows are first netted against each other as
    a multiset (copies collapse before the shuffle and nothing is paired), so only changed rows,
    two per key at most, reach the classification.
    """
    require(old, keys, "change_feed")
    if set(old.columns) != set(new.columns):
        raise ValueError("change_feed compares tables with the same columns")
    both = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    changed = both.groupBy(*old.columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return _classified(changed, keys, old.columns)


def _classified(changed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` and ``_change_type`` of rows that came or went ``_net`` times."""
    key = Window.partitionBy(*keys)
    changed = changed.withColumns(
        {"_gone": F.max(F.col("_net") < 0).over(key), "_came": F.max(F.col("_net") > 0).over(key)}
    )
    kinds = (
        F.when(F.col("_gone") & F.col("_came"), F.when(F.col("_net") < 0, "update_preimage").otherwise("update_postimage"))
        .when(F.col("_came"), "insert")
        .otherwise("delete")
    )
    copies = F.array_repeat(kinds, F.abs("_net").cast("int"))
    return changed.select(*columns, F.explode(copies).alias(CHANGE))


def table_changes(store: LoadStore, table: str, keys: Sequence[str], since: str, until: str | None = None) -> DataFrame:
    """Changes of a stored table between two of its loads (the newest one when ``until`` is None).
    Older versions can be compared as long as they have not been vacuumed."""
    old, new = (store.read(table, store.visible(table, load)) for load in (since, until))
    return change_feed(old, new, keys)


AT = "_changed_at"


def history_feed(history: DataFrame, keys: Sequence[str], since=None, until=None) -> DataFrame:
    """The changes a type 2 history records after ``since`` and up to ``until`` (its whole life without them).

    Each version gives its columns twice, with +1 where it starts and -1 where it ends; what comes and goes
    unchanged at one instant cancels out.  Of a key and instant, a row that goes and one that comes are
    ``update_preimage`` and ``update_postimage``, alone they are ``delete`` and ``insert``.  ``_changed_at`` is the instant in
    the type of the sequence; versions that start without one (a NULL sequence) are listed only where ``since`` is None.
    The validity columns themselves are not shown.

    One pass and one shuffle, by key and instant, so a key with very many versions is spread over its instants.
    """
    require(history, [*keys, START, END], "history_feed")
    kind = history.schema[START].dataType
    state = [c for c in history.columns if c not in (START, END)]
    both = F.array(
        F.struct(F.col(START).alias(AT), F.lit(1).alias("_sign"), F.lit(True).alias("_counts")),
        F.struct(F.col(END).alias(AT), F.lit(-1).alias("_sign"), F.col(END).isNotNull().alias("_counts")),
    )
    signed = history.select(*state, F.inline(both)).where("_counts")
    at = F.col(AT)
    if since is not None:
        signed = signed.where(at > F.lit(since).cast(kind))
    if until is not None:
        signed = signed.where(at.isNull() | (at <= F.lit(until).cast(kind)))
    signed = signed.repartition(*keys, AT)
    changed = signed.groupBy(*state, AT).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return _classified(changed, [*keys, AT], [*state, AT])


def apply_feed(table: DataFrame, feed: DataFrame) -> DataFrame:
    """``table`` after the changes of ``feed``; rows are added and removed as a multiset."""
    taken = F.col(CHANGE).isin("delete", "update_preimage")
    signed = feed.withColumn("_sign", F.when(taken, -1).otherwise(1)).drop(CHANGE)
    net = (
        table.withColumn("_sign", F.lit(1)).unionByName(signed)
        .groupBy(*table.columns).agg(F.sum("_sign").alias("_net")).where("_net > 0")
    )
    return net.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_net")))).select(*table.columns)
