"""Marts described by metadata: sources, joins, select list, grouping, layout."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import require
from siltstone.operators.cluster import by_folder, zorder
from siltstone.operators.history import END, current
from siltstone.sources.store import LoadStore, instant


@dataclass(frozen=True)
class Source:
    """A table under an alias.  With ``group_by`` it is aggregated before any join: its rows
    then collapse on the map side, and a key with very many rows reaches the join as one."""

    table: str
    alias: str
    group_by: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()


@dataclass(frozen=True)
class Join:
    """``right`` joined to an earlier alias ``left`` on equal columns (same or paired names)."""

    left: str
    right: str
    on: tuple[tuple[str, str], ...]
    how: str = "inner"


@dataclass(frozen=True)
class MartSpec:
    """``select`` and ``group_by`` hold SQL expressions over the aliases, ``joins`` is a chain."""

    name: str
    kind: str
    sources: tuple[Source, ...]
    joins: tuple[Join, ...]
    select: tuple[str, ...]
    group_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    grain: str | None = None

    @classmethod
    def from_dict(cls, meta: Mapping) -> MartSpec:
        """From a metadata dictionary with source_tables, table_aliases, joins, select_columns,
        group_by, partition_by and z_order_by."""
        alias = meta["table_aliases"]

        def pairs(on) -> tuple[tuple[str, str], ...]:
            listed = [on] if isinstance(on, str) else on
            return tuple((c, c) if isinstance(c, str) else (c[0], c[1]) for c in listed)

        return cls(
            name=meta["name"],
            kind=meta.get("type", "table"),
            sources=tuple(Source(t, alias[t]) for t in meta["source_tables"]),
            joins=tuple(
                Join(alias[j["left"]], alias[j["right"]], pairs(j["on"]), j["type"]) for j in meta.get("joins", ())
            ),
            select=tuple(meta["select_columns"]),
            group_by=tuple(meta.get("group_by", ())),
            partition_by=tuple(meta.get("partition_by", ())),
            cluster_by=tuple(meta.get("z_order_by", ())),
            grain=meta.get("grain"),
        )


def _input(source: Source, tables: Mapping[str, DataFrame]) -> DataFrame:
    if source.table not in tables:
        raise ValueError(f"no table {source.table}")
    df = tables[source.table]
    if source.group_by:
        require(df, source.group_by, source.table)
        df = df.groupBy(*source.group_by).agg(*[F.expr(m) for m in source.measures])
    return df.alias(source.alias)


def build(spec: MartSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The mart as one lazy plan.  Columns nothing selects never leave the scans, and the
    join strategy is left to the sizes Spark sees."""
    inputs = {s.alias: _input(s, tables) for s in spec.sources}
    df = inputs[spec.sources[0].alias]
    for join in spec.joins:
        right = inputs[join.right]
        require(inputs[join.left], [a for a, _ in join.on], join.left)
        require(right, [b for _, b in join.on], join.right)
        on = " AND ".join(f"{join.left}.`{a}` = {join.right}.`{b}`" for a, b in join.on)
        df = df.join(right, F.expr(on), join.how.lower().replace(" ", ""))
    columns = [F.expr(c) for c in spec.select]
    if not spec.group_by:
        return df.select(*columns)
    # agg() puts the grouping columns in front of the select list; keep the list alone.
    grouped = df.groupBy(*[F.expr(g) for g in spec.group_by]).agg(*columns)
    names = grouped.columns[len(spec.group_by):]
    return grouped.toDF(*[f"_g{i}" for i in range(len(spec.group_by))], *names).select(*names)


def inputs(
    logs: Mapping[str, DataFrame], tracked: Mapping[str, DataFrame] | None = None, mode: str = "current"
) -> dict[str, DataFrame]:
    """The tables marts read.  ``log`` takes the append logs, where every version of a key counts
    as a row of its own; ``current`` prefers the ``tracked`` tables, of a history its open versions."""
    if mode not in ("log", "current"):
        raise ValueError(f"mode must be log or current, not {mode!r}")
    if mode == "log":
        return dict(logs)
    opened = {n: current(t) if END in t.columns else t for n, t in (tracked or {}).items()}
    return {**logs, **opened}


def publish(spec: MartSpec, df: DataFrame, store: LoadStore, register_as: str | None = None) -> DataFrame:
    """Replaces the stored mart by ``df`` and returns the stored rows.

    A new folder is written beside the old one and the ledger row switches readers over.  With
    ``cluster_by`` the query's result is written once, then clustered from there, so the query
    runs once.  ``grain`` coarsens date folders (for instance to months).
    """
    folders = list(spec.partition_by)
    if spec.grain:
        dates = [c for c in folders if df.schema[c].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")]
        df = df.withColumns({f"{c}_{spec.grain}": F.to_date(F.date_trunc(spec.grain, c)) for c in dates})
        folders = [f"{c}_{spec.grain}" if c in dates else c for c in folders]
    version = instant()
    if spec.cluster_by:
        draft = f"{version}_draft"  # never committed, so never visible
        facts = store.write(df, spec.name, draft)
        plain = store.spark.read.schema(df.schema).parquet(store.data(spec.name, draft))
        facts |= store.write(zorder(plain, spec.cluster_by, folders), spec.name, version, partition_by=folders)
        store.discard(spec.name, draft)
    else:
        facts = store.write(by_folder(df, folders), spec.name, version, partition_by=folders)
    store.commit(spec.name, version, "full", **facts)
    if register_as:
        store.register(spec.name, register_as)
    return store.read(spec.name)


def build_all(specs, tables: Mapping[str, DataFrame], store: LoadStore) -> dict[str, DataFrame]:
    """Publishes every mart in order."""
    return {spec.name: publish(spec, build(spec, tables), store) for spec in specs}
