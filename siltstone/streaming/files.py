"""Streams over Parquet folders: each file is read once, conformed and appended.

The file stream knows files, not loads: an extract written twice after a crash is read twice.
History drops such repeats; ``siltstone.streaming.loads`` avoids them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.conform import conform
from siltstone.schemas import TableSpec


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, **options: str
) -> DataFrame:
    """New Parquet files under ``path`` as an unbounded table.  ``options`` are those of the
    file source, such as ``cleanSource`` or ``maxFileAge``."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_append(
    df: DataFrame, path: str, checkpoint: str, table: str | None = None
) -> StreamingQuery:
    """Starts an append of everything available now, then stops by itself."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .trigger(availableNow=True)
    )
    return writer.toTable(table, path=path) if table else writer.start(path)


def start_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Starts ``handle(batch, batch_id)`` over everything available now."""
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(*queries: StreamingQuery) -> None:
    """Waits for every query; the first failure is raised after all have ended."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:
            failures.append(error)
    if failures:
        raise failures[0]


def start_silver(
    spark: SparkSession, spec: TableSpec, bronze: str, schema: T.StructType, silver: str, checkpoint: str,
    table: str | None = None, strict: bool = False, stamp: bool = True, max_files: int | None = None,
) -> StreamingQuery:
    """Bronze files to one silver table.  Start several and ``finish`` them together."""
    rows = conform(file_stream(spark, bronze, schema, max_files), spec, strict, stamp)
    return start_append(rows, silver, checkpoint, table)
