"""Where source tables come from.  Each source returns a lazy DataFrame for ``schema.table``,
so filters and column lists written on it reach the database or the Parquet scan."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*")


def _identifier(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


@dataclass(frozen=True)
class ParquetSource:
    """Tables as Parquet under ``root``; ``pattern`` places schema and table in the path."""

    root: str
    pattern: str = "{table}.parquet"

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{self.pattern.format(schema=schema, table=table)}")


@dataclass(frozen=True)
class CatalogSource:
    """Tables or views registered in the session catalog."""

    with_schema: bool = True

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.table(f"{_identifier(schema)}.{_identifier(table)}" if self.with_schema else _identifier(table))


@dataclass(frozen=True)
class FrameSource:
    """Tables given as DataFrames by name."""

    tables: dict[str, DataFrame]

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return self.tables[table]


@dataclass(frozen=True)
class Split:
    """How to read one database table over several connections."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database over JDBC.

    ``splits`` names, per table, a numeric or time column and its range: Spark then opens
    ``partitions`` connections with disjoint ranges (rows outside the range are still read, by
    the first and last).  A table without a split is read over one connection.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000
    query_timeout: int = 7200

    def options(self, schema: str, table: str) -> dict[str, str]:
        chosen = {
            **self.properties,
            "url": self.url,
            "dbtable": f"{_identifier(schema)}.{_identifier(table)}",
            "fetchsize": str(self.fetch_size),
            "queryTimeout": str(self.query_timeout),
            "pushDownPredicate": "true",
        }
        split = self.splits.get(table)
        if split:
            chosen |= {
                "partitionColumn": _identifier(split.column),
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return chosen

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(schema, table)).load()
