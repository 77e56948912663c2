"""Bronze ingestion: full and incremental extracts with committed high-water marks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import require
from siltstone.operators.cluster import by_folder
from siltstone.schemas import FIRST_WATERMARK, LoadSpec, instant_text
from siltstone.session import control_rows
from siltstone.sources.store import LoadStore, instant

STATUS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("cdc", T.StringType()),
    ]
)


def lower_bound(load: LoadSpec, last: str | None) -> str | None:
    """The backdate when one is given, else the stored watermark."""
    return load.from_date or last


def _dated(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType))


def mark_text(col: Column, kind: T.DataType) -> Column:
    """A value as text that reads back the same in every session: an instant is written in UTC, with its zone,
    so the hour that a zone's clocks repeat stays two hours."""
    return instant_text(col, kind).cast("string")


def extract(
    rows: DataFrame, load: LoadSpec, last: str | None, overlap: str | None = None, include_null: bool = False,
    last_key: Sequence[str] = (),
) -> DataFrame:
    """The rows of one load: all of them, or those beyond the lower bound.

    The bound is a literal of the column's own type, so the comparison reaches the scan.  A row
    equal to the bound or without a value stays out; ``overlap`` (an interval such as
    ``"1 hour"``) re-reads a margin below the bound and ``include_null`` adds rows without a value.
    With ``last_key``, the load's ``cdc_key`` of the last row seen, rows equal to the bound come too if their
    key is greater; so rows that share a value with the mark are neither lost nor read twice.  Without a bound
    every row with a value comes.
    """
    if not load.incremental:
        return rows
    require(rows, [load.cdc_column, *load.cdc_key], load.table)
    column = F.col(load.cdc_column)
    text = lower_bound(load, last)
    if text is None:
        return rows if include_null else rows.where(column.isNotNull())
    bound = _typed(rows, load.cdc_column, text)
    if overlap:
        bound = bound - F.expr(f"INTERVAL '{overlap}'")
    wanted = column > bound
    if last_key and not overlap and not load.from_date:
        beyond, level = F.lit(False), column == bound
        for name, value in zip(load.cdc_key, last_key, strict=True):
            at = _typed(rows, name, value)
            beyond, level = beyond | (level & (F.col(name) > at)), level & (F.col(name) == at)
        # Said once for the scan, then exactly.
        wanted = (column >= bound) & (wanted | beyond)
    return rows.where(wanted | column.isNull() if include_null else wanted)


def _typed(rows: DataFrame, name: str, text: str) -> Column:
    return F.lit(text).cast(rows.schema[name].dataType)


def ingest(
    spark: SparkSession, source, load: LoadSpec, store: LoadStore, overlap: str | None = None,
    include_null: bool = False, count_nulls: bool = False, gather: bool = False,
) -> dict:
    """Runs one load and returns its status row.

    Output files follow the source's partitions.  ``gather`` shuffles an increment into files of
    AQE's advisory size first: worth it for a small increment picked from very many partitions.

    Rows, count and new watermark come from one pass over the extract, so the watermark never
    runs ahead of what was copied.  It never moves back, and a load without rows commits nothing.
    """
    rows = source.read(spark, load.schema, load.table)
    load_id = instant()
    if not load.incremental:
        facts = store.write(rows, load.table, load_id)
        store.commit(load.table, load_id, "full", **facts)
        return _status(load, facts["rows"], None)

    cdc, key = store.mark(load.table)
    kind = rows.schema[load.cdc_column].dataType
    # Times have a first mark before any load; numbers have none.
    last = cdc or (FIRST_WATERMARK if _dated(kind) else None)
    data = extract(rows, load, last, overlap, include_null, key if load.cdc_key else ())
    bound = lower_bound(load, last)
    ordered = [load.cdc_column, *load.cdc_key]
    place = F.struct(*ordered)
    newest = F.max(F.when(F.col(load.cdc_column).isNotNull(), place))
    if last is not None:
        given = [key[i] if i < len(key) else None for i in range(len(load.cdc_key))]
        reached = F.struct(*[(F.lit(v).cast(rows.schema[c].dataType)).alias(c) for c, v in zip(ordered, [last, *given])])
        newest = F.greatest(newest, reached)
    metrics = {"cdc": mark_text(newest[load.cdc_column], kind)}
    if load.cdc_key:
        metrics["cdc_key"] = F.array(*[mark_text(newest[c], rows.schema[c].dataType) for c in load.cdc_key])
    if last is not None:
        # A backdate beyond the watermark leaves unread rows between the two.
        metrics["gap"] = F.max(_typed(rows, load.cdc_column, bound) > _typed(rows, load.cdc_column, last))
    facts = {"gap": False} | store.write(by_folder(data, []) if gather else data, load.table, load_id, metrics)
    if facts["rows"] == 0:
        return _status(load, 0, last)
    if count_nulls:
        facts["null_cdc_rows"] = rows.where(F.col(load.cdc_column).isNull()).count()
    store.commit(load.table, load_id, "incremental", lower_bound=bound, **facts)
    return _status(load, facts["rows"], facts["cdc"])


def _status(load: LoadSpec, rows: int, cdc: str | None) -> dict:
    return {"table": load.table, "strategy": load.load_strategy, "rows": rows, "cdc": cdc}


def ingest_all(
    spark: SparkSession, source, loads: Iterable[LoadSpec], store: LoadStore, parallel: int = 1, **options
) -> DataFrame:
    """Runs every load of the configuration, up to ``parallel`` at a time; one status row each.

    All loads are attempted; the first failure is raised afterwards.
    """
    loads = list(loads)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        jobs = [pool.submit(ingest, spark, source, load, store, **options) for load in loads]
    return control_rows(spark, [job.result() for job in jobs], STATUS)
