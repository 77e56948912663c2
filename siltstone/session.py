"""Session settings and the shared working folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime SQL settings the plans here rely on.  Sizes (shuffle partitions, broadcast
# limit, split size) stay with the cluster: AQE coalesces and splits from there.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the aggregate above then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables and stream checkpoints, on storage every executor reaches.

    It lies under ``spark.checkpoint.dir``.  Only a local session may go without that
    setting; a machine's own temporary folder is of no use to a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="siltstone-")
    return f"{root.rstrip('/')}/siltstone/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so that later steps start from there even
    when executors are lost, and know its size.  It is computed once; a checkpoint would compute it twice."""
    path = workspace(df.sparkSession, "steps")
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    plain.write.parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*df.columns)


# Rows of a few fixed-width columns: some tens of MB in memory.
BROADCAST_ROWS = 1_000_000


def measured(df: DataFrame) -> DataFrame:
    """A small result of fixed-width columns, computed once and counted: broadcast when it has at
    most ``BROADCAST_ROWS`` rows, else joined as Spark sees fit.

    Spark's own estimate of an aggregate follows the table below it, so without the count a join
    with a handful of rows would first shuffle the large side."""
    kept = saved(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def control_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows of bookkeeping as a DataFrame, made in the JVM without Python workers."""
    text = json.dumps(rows, default=lambda v: v.isoformat() if isinstance(v, datetime) else str(v))
    parsed = F.from_json(F.lit(text), T.ArrayType(schema), {"mode": "FAILFAST"})
    return spark.range(1, numPartitions=1).select(F.inline(parsed))
