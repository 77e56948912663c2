"""Streams over committed loads: what the ledger lists is processed exactly once.

The stream reads the ledger (one small row per load); the data folders of the new loads are
read inside the batch.  A load that failed before its commit is never seen, and a batch run
again writes the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.conform import conform, losses
from siltstone.schemas import TableSpec
from siltstone.sources.store import LEDGER, LoadStore, observed
from siltstone.streaming.files import start_batches


def start_loads(
    store: LoadStore, table: str, handle: Callable[[DataFrame, int, bool], None], checkpoint: str,
    max_loads: int | None = None,
) -> StreamingQuery:
    """Calls ``handle(rows, batch_id, replaces)`` with the rows of newly committed loads.

    ``replaces`` is true when they begin with a full load: the rows are then the whole table,
    not an addition to it.
    """
    reader = store.spark.readStream.schema(LEDGER)
    if max_loads:
        reader = reader.option("maxFilesPerTrigger", max_loads)

    def each(batch: DataFrame, batch_id: int) -> None:
        loads = batch.orderBy("committed_at", "load_id").collect()
        fulls = [i for i, load in enumerate(loads) if load.strategy == "full"]
        if fulls:
            loads = loads[fulls[-1]:]
        if loads:
            handle(store.read(table, loads), batch_id, bool(fulls))

    return start_batches(reader.parquet(store.ledger_path(table)), each, checkpoint)


def start_conform(
    bronze: LoadStore, silver: LoadStore, spec: TableSpec, checkpoint: str, strict: bool = False, stamp: bool = True,
    transform: Callable[[DataFrame], DataFrame] | None = None, max_loads: int | None = None,
    count_losses: bool = True,
) -> StreamingQuery:
    """Committed bronze loads to committed silver loads; a full load replaces the silver table.

    ``transform`` adds work on the conformed rows, such as cleaning or expectations.  Values
    that do not convert are counted per column in the silver ledger.
    """

    def handle(rows: DataFrame, batch_id: int, replaces: bool) -> None:
        load_id = f"b{batch_id:09d}"
        if silver.committed(spec.name, load_id):
            return
        rows, lost = observed(rows, losses(rows, spec) if count_losses and not strict else {})
        out = conform(rows, spec, strict, stamp)
        out = transform(out) if transform else out
        silver.put(out, spec.name, load_id, "full" if replaces else "incremental", counts=lost)

    return start_loads(bronze, spec.name, handle, checkpoint, max_loads)
