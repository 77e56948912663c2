"""Tables as committed loads: data folders plus a ledger that says which of them count.

    <root>/data/<table>/load_id=<id>/...   Parquet, one folder per load
    <root>/ledger/<table>/...              one small row per committed load, written last

A load that failed before its ledger row is invisible, and writing it again replaces its
folder.  Readers list committed loads first and open exactly those folders.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import FIRST_WATERMARK, evolve, exists, widened
from siltstone.session import control_rows

LEDGER = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("strategy", T.StringType()),  # full | incremental
        T.StructField("rows", T.LongType()),
        T.StructField("cdc", T.StringType()),
        T.StructField("cdc_key", T.ArrayType(T.StringType())),  # of the last row at that mark, where the load names keys
        T.StructField("lower_bound", T.StringType()),
        T.StructField("gap", T.BooleanType()),
        T.StructField("null_cdc_rows", T.LongType()),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),  # failed rules, lost values, buckets
        T.StructField("schema", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)


def instant() -> str:
    """The load instant as a sortable name."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


class LoadStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def data(self, table: str, load_id: str | None = None) -> str:
        base = f"{self.root}/data/{table}"
        return base if load_id is None else f"{base}/load_id={load_id}"

    def ledger_path(self, table: str) -> str:
        return f"{self.root}/ledger/{table}"

    # -- writing ---------------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        table: str,
        load_id: str,
        metrics: dict[str, Column] | None = None,
        partition_by: Sequence[str] = (),
    ) -> dict:
        """Writes one load and returns its row count and other ``metrics``, from the same pass.

        The counters sit in the write's own stage, where Spark counts each finished task once.
        """
        seen = Observation()
        counted = {"rows": F.count(F.lit(1)), **(metrics or {})}
        observed = df.observe(seen, *[c.alias(n) for n, c in counted.items()])
        writer = observed.write.mode("overwrite").option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.data(table, load_id))
        return {**seen.get, "schema": df.schema.json()}

    def commit(self, table: str, load_id: str, strategy: str, **facts) -> dict:
        """Appends the ledger row that makes a load visible."""
        row = {f.name: facts.get(f.name) for f in LEDGER.fields}
        row |= {
            "table": table,
            "load_id": load_id,
            "strategy": strategy,
            "committed_at": datetime.now(timezone.utc),
        }
        control_rows(self.spark, [row], LEDGER).write.mode("append").parquet(self.ledger_path(table))
        return row

    def put(
        self, df: DataFrame, table: str, load_id: str | None = None, strategy: str = "incremental",
        partition_by: Sequence[str] = (), counts: Observation | None = None,
    ) -> dict:
        """Write and commit in one step.  ``counts`` is an observation inside ``df``; its numbers go to the ledger."""
        load_id = load_id or instant()
        facts = self.write(df, table, load_id, partition_by=partition_by)
        if counts is not None:
            facts["counts"] = counts.get
        return self.commit(table, load_id, strategy, **facts)

    # -- reading ---------------------------------------------------------------------------

    def ledger(self, table: str) -> DataFrame:
        path = self.ledger_path(table)
        if not exists(self.spark, path):
            return control_rows(self.spark, [], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(path)

    def watermark(self, table: str) -> DataFrame:
        """One row: the table's committed high-water mark, or the first one before any load."""
        return self._marks(table).select(F.lit(table).alias("table"), F.coalesce("cdc", F.lit(FIRST_WATERMARK)).alias("cdc"))

    def _marks(self, table: str) -> DataFrame:
        newest = F.max_by(F.struct("cdc", "cdc_key"), F.struct("committed_at", "load_id")).alias("mark")
        return self.ledger(table).where(F.col("cdc").isNotNull()).agg(newest).select("mark.cdc", "mark.cdc_key")

    def mark(self, table: str) -> tuple[str | None, list[str]]:
        """The committed high-water mark as text, None before any load, and the keys of the last row at it."""
        found = self._marks(table).first()
        return found.cdc, found.cdc_key or []

    def visible(self, table: str, upto: str | None = None) -> list:
        """Ledger rows (control data, one per load) that make up the table: the newest full load
        and everything after it; older rows stay in the ledger.  ``upto`` gives the table as it was after that load."""
        place = F.struct("committed_at", "load_id")
        rows = self.ledger(table)
        if upto is not None:
            rows = rows.where(place <= rows.where(F.col("load_id") == upto).agg(F.max(place)).scalar())
        newest = rows.where("strategy = 'full'").agg(F.max(place)).scalar()
        rows = rows.where(newest.isNull() | (place >= newest))
        return sorted(rows.collect(), key=lambda r: (r.committed_at, r.load_id))

    def load(self, table: str, load_id: str) -> list:
        """The ledger row of one load, or nothing."""
        return self.ledger(table).where(F.col("load_id") == load_id).limit(1).collect()

    def committed(self, table: str, load_id: str) -> bool:
        return bool(self.load(table, load_id))

    def read(self, table: str, loads: Sequence | None = None, where: str | None = None) -> DataFrame:
        """The rows of the visible (or the given) loads.  Columns that some loads lack are NULL; a column whose type
        changed has the narrowest type that keeps all its values, text if need be.

        ``where`` may name partition columns only; it prunes folders before any file is opened.
        """
        loads = self.visible(table) if loads is None else list(loads)
        if not loads:
            raise LookupError(f"{table}: no committed load under {self.root}")
        own = [T.StructType.fromJson(json.loads(load.schema)) for load in loads]
        merged = reduce(evolve, own, None)
        # Loads that fit the merged types are read together, others by the types they were written in.
        kinds: dict[str, tuple[T.StructType, list[str]]] = {}
        for load, schema in zip(loads, own):
            fits = all(merged[f.name].dataType.simpleString() == f.dataType.simpleString() for f in schema.fields)
            given = merged if fits else schema
            if load.rows:
                kinds.setdefault(given.json(), (given, []))[1].append(self.data(table, load.load_id))
        if not kinds:
            return control_rows(self.spark, [], merged)
        parts = []
        for schema, paths in kinds.values():
            df = self.spark.read.schema(schema).option("basePath", self.data(table)).parquet(*paths)
            parts.append(widened(df.where(where) if where else df, merged))
        return reduce(DataFrame.unionByName, parts)

    def register(self, table: str, name: str) -> None:
        """(Re)points a catalog table at the newest full load of ``table``."""
        [load, *later] = self.visible(table)
        if load.strategy != "full" or later:
            raise ValueError(f"{table}: only a table replaced as a whole can be registered by its folder")
        path, schema = self.data(table, load.load_id), self.read(table, [load]).schema
        catalog = self.spark.catalog
        if catalog.tableExists(name) and set(self.spark.table(name).dtypes) != set(_dtypes(schema)):
            self.spark.sql(f"DROP TABLE {name}")
        if catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            catalog.createTable(name, path=path, source="parquet", schema=schema)
        catalog.refreshTable(name)

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def discard(self, table: str, load_id: str) -> None:
        """Deletes the folder of a load that was never committed."""
        if self.committed(table, load_id):
            raise ValueError(f"{table}: load {load_id} is committed")
        folder, files = self._files(self.data(table, load_id))
        files.delete(folder, True)

    def vacuum(self, table: str, older_than_hours: float = 24.0) -> list[str]:
        """Deletes load folders no reader of the committed table opens: failed and empty loads and
        replaced versions.  Younger folders stay, as a job may still use them."""
        used = {load.load_id for load in self.visible(table) if load.rows}
        base, files = self._files(self.data(table))
        limit = (datetime.now(timezone.utc).timestamp() - older_than_hours * 3600) * 1000
        dropped = []
        for entry in files.listStatus(base) if files.exists(base) else []:
            load_id = entry.getPath().getName().removeprefix("load_id=")
            if load_id not in used and entry.getModificationTime() <= limit:
                files.delete(entry.getPath(), True)
                dropped.append(load_id)
        return sorted(dropped)


def observed(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation | None]:
    """``df`` with ``counters`` taken as its rows pass by.  Exact when no shuffle lies between
    here and the write, since Spark counts each finished task of the writing stage once."""
    if not counters:
        return df, None
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen


def _dtypes(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
