"""What several operators of this subpackage share: words, stored steps, connected groups."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.session import workspace

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Stands for a null id in keys, so that such rows come last.
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps start from the files, so a
    lost executor costs its own tasks only."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text (null: empty) with a key ``_k1, _k2`` that is never null.

    Rows that repeat an id with the same text share a key; the same id with another text is
    another document.  All other columns stay outside, so their names can't clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_k1"),
        F.xxhash64(text).alias("_k2"),
        text.alias("_text"),
    )


def key_columns(df: DataFrame, id_col: str, text_col: str) -> tuple:
    """The key of ``keyed`` as expressions over ``df``."""
    return F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(df[text_col], F.lit("")))


def one_of_each(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with one row of those that repeat an id (or have none) and a text with words: the first by its values.

    Only rows that repeat meet in a shuffle, and at most one of each task does."""
    one, two = key_columns(df, id_col, text_col)
    tagged = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), one.alias("_k1"), two.alias("_k2"), df[text_col].rlike(WORD).alias("_words"))
    many = tagged.where("_words").groupBy("_k1", "_k2").count().where("count > 1").select("_k1", "_k2")
    many = stored(many, "repeated")
    if many.isEmpty():
        return df
    on = ["_k1", "_k2"]
    first = Window.partitionBy(*on).orderBy(F.to_json("_row"))
    again = tagged.join(many, on, "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return tagged.join(many, on, "left_anti").select("_row.*").unionByName(again.select("_row.*"))


# -- hashes of word runs ------------------------------------------------------------------


_MUL = np.uint64(0x9E3779B97F4A7C15)
_FIN = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _FIN
    x = (x ^ (x >> _SHIFT)) * _FIN
    return x ^ (x >> _SHIFT)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries, by doubling: log2(n) vector steps."""
    if len(hashes) < n:
        return hashes[:0]
    level, width, out, done = mixed(hashes + np.uint64(n)), 1, None, 0
    while True:
        if n & width:
            if out is None:
                out = level
            else:
                size = len(hashes) - done - width + 1
                out = mixed(out[:size] * _MUL + level[done : done + size])
            done += width
        if 2 * width > n:
            return out[: len(hashes) - n + 1]
        size = len(level) - width
        level = mixed(level[:size] * _MUL + level[width : width + size])
        width *= 2


# -- connected groups ---------------------------------------------------------------------


def components(links: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """``id, component`` for every id in ``links``; the component is its smallest id.

    Alternates large and small stars: each round replaces a node's links by links to the least
    neighbour, with a minimum per node (combined before the shuffle) and a join that AQE can split
    on hot nodes.  Rounds grow with the logarithm of the longest path; each is stored."""
    a, b = F.least(low, high), F.greatest(low, high)

    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        """The stored edges and a mark of them, taken while they are written."""
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
        out = stored(df, "links")
        return out, (seen.get["n"], seen.get["s"])

    edges, before = kept(links.where(F.col(low) != F.col(high)).select(b.alias("u"), a.alias("v")).distinct())
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = kept(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
