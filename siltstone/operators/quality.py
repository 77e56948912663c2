"""Expectations: named SQL predicates that rows must satisfy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import holds
from siltstone.sources.store import LoadStore, observed


def expect(df: DataFrame, rules: dict[str, str], on_fail: str = "drop") -> DataFrame:
    """Applies ``rules`` to a batch or a stream.

    ``drop`` keeps rows for which every rule is TRUE; ``keep`` keeps all rows and lists the
    failed rules in ``_failed``; ``fail`` stops the job at the first failing row.  A rule whose
    outcome is NULL has failed.
    """
    if on_fail == "drop":
        return df.where(reduce(lambda a, b: a & b, [holds(p) for p in rules.values()], F.lit(True)))
    if on_fail == "keep":
        failed = [F.when(~holds(p), F.lit(name)) for name, p in rules.items()]
        return df.withColumn("_failed", F.array_compact(F.array(*failed)))
    if on_fail == "fail":
        checks = [
            F.when(holds(p), F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean"))
            for name, p in rules.items()
        ]
        return df.where(reduce(lambda a, b: a & b, checks, F.lit(True)))
    raise ValueError(f"on_fail must be drop, keep or fail, not {on_fail!r}")


def counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Per rule: rows that passed and rows that failed, in one aggregation over the table."""
    tallies = [F.count_if(holds(p)).alias(f"p{i}") for i, p in enumerate(rules.values())]
    one = df.agg(F.count(F.lit(1)).alias("n"), *tallies)
    per_rule = [
        F.struct(F.lit(name).alias("rule"), F.col(f"p{i}").alias("passed"), (F.col("n") - F.col(f"p{i}")).alias("failed"))
        for i, name in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*per_rule)))


def failures(rules: dict[str, str]) -> dict[str, Column]:
    """Counters of failing rows per rule, to be observed while the rows are written."""
    return {f"failed_{name}": F.count_if(~holds(p)) for name, p in rules.items()}


REJECTED, FAILED = "_rejected", "_failed"


def divide(df: DataFrame, rules: dict[str, str], store: LoadStore, table: str, load_id: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that keep every rule, and the others with the names of the rules they break (``_failed``).

    Both are written in one pass, as one load of ``table`` with a folder for each, together with exact counts in the
    ledger: rows that fail each rule, and rejected rows.  Running the same load again only reads it.
    """
    if not store.committed(table, load_id):
        marked = expect(df, rules, "keep").withColumn(REJECTED, F.size(FAILED) > 0)
        marked, seen = observed(marked, {**failures(rules), "rejected": F.count_if(REJECTED)})
        # No shuffle before the write, so that the counts stay exact when tasks run again.
        store.put(marked, table, load_id, partition_by=[REJECTED], counts=seen)
    loads = store.load(table, load_id)
    good = store.read(table, loads, where=f"NOT {REJECTED}").drop(REJECTED, FAILED)
    return good, store.read(table, loads, where=REJECTED).drop(REJECTED)


def in_set(column: str, values: list[str]) -> str:
    """A rule text: the column holds one of ``values``."""
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{column} IN ({listed})"
