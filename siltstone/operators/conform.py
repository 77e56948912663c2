"""Conform source rows to a silver table: select, convert, stamp, clean, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import require
from siltstone.functions.order import last_resort
from siltstone.schemas import INGESTED_AT, TableSpec


def converted(df: DataFrame, name: str, kind: str | None, strict: bool) -> Column:
    """``name`` as ``kind``.  A value that does not convert is NULL, or an error when strict."""
    if name not in df.columns:
        return F.lit(None).cast(kind or "string").alias(name)
    col = F.col(name)
    source = df.schema[name].dataType
    if kind is None:
        return col
    if isinstance(source, T.BooleanType) and kind not in ("boolean", "string"):
        # A truth value is not a number, and no date either.
        wrong = F.raise_error(F.lit(f"{name}: boolean cannot become {kind}")) if strict else F.lit(None)
        return F.when(col.isNotNull(), wrong.cast(kind)).alias(name)
    if kind == "timestamp" and isinstance(source, T.StringType):
        return (F.to_timestamp(col) if strict else F.try_to_timestamp(col)).cast("timestamp").alias(name)
    return (col.cast(kind) if strict else col.try_cast(kind)).alias(name)


RESCUED = "_rescued"


def rescued(df: DataFrame, spec: TableSpec) -> Column:
    """What does not fit the columns of ``spec``: a map from the column's name to the value as text."""
    found = [
        F.when(F.col(n).isNotNull() & converted(df, n, k, False).isNull(), F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")))
        for n, k in spec.columns.items()
        if k is not None and n in df.columns
    ]
    return F.map_from_entries(F.array_compact(F.array(*found))).alias(RESCUED)


def conform(
    df: DataFrame, spec: TableSpec, strict: bool = False, stamp: bool = True, rescue: bool = False
) -> DataFrame:
    """The silver projection; works alike on a batch and on a stream.

    A source without a key column, or, if strict, without any column, is an error; other missing
    columns are NULL.  With ``rescue`` a column ``_rescued`` keeps the values that do not convert."""
    require(df, list(spec.columns) if strict else [k for k in spec.keys if k in spec.columns], "conform")
    columns = [converted(df, name, kind, strict) for name, kind in spec.columns.items()]
    if rescue:
        columns.append(rescued(df, spec))
    if stamp:
        columns.append(F.current_timestamp().alias(INGESTED_AT))
    return df.select(*columns)


def losses(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Counters per converted column of ``df``: values that are present but do not convert."""
    return {
        n: F.count_if(F.col(n).isNotNull() & converted(df, n, k, False).isNull())
        for n, k in spec.columns.items()
        if k is not None and n in df.columns
    }


def conversion_losses(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row with the ``losses`` of a table."""
    return df.agg(*[c.alias(n) for n, c in losses(df, spec).items()])


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Trim text, upper-case state codes, drop rows without a full primary key."""
    require(df, spec.keys, spec.name)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    trimmed = {c: F.upper(F.trim(c)) if c in spec.upper else F.trim(c) for c in text}
    return df.withColumns(trimmed).dropna(subset=list(spec.keys))


def latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ignored: Sequence[str] = (), last: Sequence[str] = ()
) -> DataFrame:
    """The last row of each key by ``order`` (most significant first); of equal ones the greatest by all its
    other columns but the ``ignored`` ones, taken by name, so the choice never depends on arrival.  ``last`` names
    columns that count after all others.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a map task
    sends at most one row per key, however many copies or versions a key has.
    """
    require(df, [*keys, *order], "latest")
    ranked = [*map(F.col, order), *last_resort(df, [*keys, *order, *ignored, *last]), *map(F.col, last)]
    newest = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in ranked])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
