"""The layers as one lakehouse: load, conform, track and build, each step incremental."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.conform import clean
from siltstone.operators.quality import REJECTED, divide, expect, failures
from siltstone.plans.catalog import MARTS
from siltstone.plans.marts import MartSpec, build_all, inputs
from siltstone.schemas import INGESTED_AT, LOADS, SPECS, LoadSpec, TableSpec
from siltstone.sources.ingest import ingest_all
from siltstone.sources.store import LoadStore, observed
from siltstone.streaming.changes import ChangeTarget
from siltstone.streaming.files import finish
from siltstone.streaming.loads import start_conform, start_loads


class Lake:
    """Stores for the four layers under ``root``, which every executor must reach."""

    def __init__(
        self, spark: SparkSession, root: str, specs: Mapping[str, TableSpec] = SPECS, buckets: int = 64,
        scd_types: Mapping[str, int] | None = None,
    ):
        self.spark, self.root, self.specs = spark, root.rstrip("/"), dict(specs)
        self.bronze, self.silver, self.tracked, self.gold = (
            LoadStore(spark, f"{self.root}/{layer}") for layer in ("bronze", "silver", "tracked", "gold")
        )
        self.targets = {
            s.name: ChangeTarget(
                self.tracked, s.name, s.keys, s.sequence, s.ties, deletes=s.deletes, tracked=s.tracked,
                except_columns=(INGESTED_AT,), scd_type=(scd_types or {}).get(s.name, 2), buckets=buckets,
            )
            for s in self.specs.values()
            if s.sequence
        }

    def _checkpoint(self, step: str, table: str) -> str:
        return f"{self.root}/checkpoints/{step}/{table}"

    def _loaded(self, store: LoadStore) -> list[TableSpec]:
        return [s for s in self.specs.values() if store.visible(s.name)]

    def load(self, source, loads: Iterable[LoadSpec] = LOADS, **options) -> DataFrame:
        """Source tables to bronze; one status row per table."""
        return ingest_all(self.spark, source, loads, self.bronze, **options)

    def conform(self, strict: bool = False, cleaned: bool = False) -> None:
        """New bronze loads to silver, all tables side by side."""
        finish(*[
            start_conform(
                self.bronze, self.silver, s, self._checkpoint("silver", s.name), strict,
                transform=(lambda rows, s=s: clean(rows, s)) if cleaned else None,
            )
            for s in self._loaded(self.bronze)
        ])

    def track(self) -> None:
        """New silver loads to history, and to checked rows for tables that keep no history."""
        queries = []
        for s in self._loaded(self.silver):
            handle = self._apply(s) if s.name in self.targets else self._check(s)
            queries.append(start_loads(self.silver, s.name, handle, self._checkpoint("tracked", s.name)))
        finish(*queries)

    def _apply(self, spec: TableSpec):
        """Rows that break a rule are put aside before any version is opened."""
        target = self.targets[spec.name]

        def handle(rows: DataFrame, batch_id: int, _: bool) -> None:
            if spec.rules:
                rows, _bad = divide(rows, spec.rules, self.tracked, self._aside(spec.name), f"b{batch_id:09d}")
            target.apply(rows, batch_id)

        return handle

    @staticmethod
    def _aside(table: str) -> str:
        return f"{table}_checked"

    def rejects(self, table: str) -> DataFrame:
        """The rows of a tracked table that opened no version, with the rules they broke."""
        return self.tracked.read(self._aside(table), where=REJECTED).drop(REJECTED)

    def _check(self, spec: TableSpec):
        def handle(rows: DataFrame, batch_id: int, replaces: bool) -> None:
            load_id = f"b{batch_id:09d}"
            if not self.tracked.committed(spec.name, load_id):
                rows, failed = observed(rows, failures(spec.rules))
                good = expect(rows.drop(INGESTED_AT), spec.rules)
                self.tracked.put(good, spec.name, load_id, "full" if replaces else "incremental", counts=failed)

        return handle

    def tables(self, mode: str = "current") -> dict[str, DataFrame]:
        """What marts read: ``log`` the silver rows as they came, ``current`` the open versions
        and the checked rows."""
        logs = {s.name: self.silver.read(s.name) for s in self._loaded(self.silver)}
        if mode == "log":
            return logs
        kept = {s.name for s in self._loaded(self.tracked)}
        current = {n: t.current() for n, t in self.targets.items() if n in kept}
        checked = {n: self.tracked.read(n) for n in kept if n not in self.targets}
        return inputs(logs, {**checked, **current}, mode)

    def build(self, marts: Iterable[MartSpec] = MARTS, mode: str = "current") -> dict[str, DataFrame]:
        """Publishes the marts."""
        return build_all(marts, self.tables(mode), self.gold)

    def vacuum(self, older_than_hours: float = 24.0) -> None:
        """Deletes what failed loads and replaced versions left behind, in every layer."""
        tables = {s.name for s in self.specs.values()}
        for store in (self.bronze, self.silver):
            for table in tables:
                store.vacuum(table, older_than_hours)
        for table in tables | {t.log for t in self.targets.values()} | {self._aside(n) for n in self.targets}:
            self.tracked.vacuum(table, older_than_hours)

    def refresh(
        self, source, loads: Iterable[LoadSpec] = LOADS, marts: Iterable[MartSpec] = MARTS, mode: str = "current",
        strict: bool = False, cleaned: bool = False, **options,
    ) -> DataFrame:
        """One run through all layers; returns the load status.

        ``strict`` and ``cleaned`` are those of ``conform``; which columns open versions and which rules hold is
        said by the specs (``schemas.documented()`` for all that is documented)."""
        status = self.load(source, loads, **options)
        self.conform(strict, cleaned)
        self.track()
        self.build(marts, mode)
        return status
