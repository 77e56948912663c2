"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

A query's score of a document is a sum over its terms.  Pairs of terms that several queries share are mined,
the most frequent first, and each becomes a node of its own, which may be paired again: queries then
are sums over the nodes of a graph that they share.  For a block of documents the contribution of
every term is laid out once, partial sums are taken node by node, and a query adds up the few nodes that
are left of it.  All sums are of whole numbers, so the order of additions does not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import table

TOP = 50
PART_CHARS = 1_000_000  # characters of queries that are answered in one pass
SHARED = 3  # queries that must share a pair before it becomes a node
ROUNDS = 12
CELLS = 4_000_000  # 8-byte numbers held for a block of documents
SALTS = 64  # groups in which the best of tasks are merged before the last merge

# Bytes of term characters: digits, ASCII letters (A-Z lowered), everything beyond ASCII.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


@dataclass
class Plan:
    """Queries over a graph.  Numbers below ``len(terms)`` are terms; node ``i`` of ``left`` and ``right``,
    numbered from there on, is the sum of two smaller numbers.  ``levels`` are the bounds of nodes
    that need only what lies before them.  Query ``i`` is the sum of ``links[starts[i] : starts[i + 1]]``."""

    ids: list
    terms: dict[bytes, int]
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    links: np.ndarray
    starts: np.ndarray


def _pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of numbers that share a query, as one key, with the count of queries."""
    keys = [np.zeros(0, np.int64)]
    for s in sets:
        i, j = np.triu_indices(len(s), 1)
        keys.append(s[i] << 32 | s[j])
    return np.unique(np.concatenate(keys), return_counts=True)


def mine(queries: list[tuple]) -> Plan:
    """The shared graph of ``(id, terms)``; each round pairs numbers greedily, the most shared first."""
    terms = {t: i for i, t in enumerate(sorted(set().union(*(ts for _, ts in queries))))}
    sets = [np.array(sorted(terms[t] for t in ts), np.int64) for _, ts in queries]
    left, right, levels, size = [], [], [0], len(terms)
    for _ in range(ROUNDS):
        shares = np.bincount(np.concatenate([np.zeros(0, np.int64), *sets]), minlength=size)
        keys, counts = _pairs([s[shares[s] >= SHARED] for s in sets])
        enough = counts >= SHARED
        taken, new = set(), {}
        order = np.lexsort((keys[enough], -counts[enough]))
        for key in keys[enough][order].tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            if a not in taken and b not in taken:
                taken |= {a, b}
                new[a] = (b, size + len(new))
        if not new:
            break
        left += list(new)
        right += [b for b, _ in new.values()]
        levels.append(len(left))
        size += len(new)
        for k, s in enumerate(sets):
            own = set(s.tolist())
            for a in [a for a in own if a in new and new[a][0] in own]:
                own -= {a, new[a][0]}
                own.add(new[a][1])
            sets[k] = np.array(sorted(own), np.int64)
    starts = np.cumsum([0, *map(len, sets)])
    return Plan([i for i, _ in queries], terms, np.array(left, np.int64), np.array(right, np.int64), levels, np.concatenate([np.zeros(0, np.int64), *sets]), starts)


def scores(plan: Plan, given: np.ndarray) -> np.ndarray:
    """Scores (queries x documents) from the contributions of terms (terms x documents)."""
    width, base = given.shape[1], len(plan.terms)
    nodes = np.empty((base + len(plan.left), width), np.int64)
    nodes[:base] = given
    for a, b in zip(plan.levels, plan.levels[1:]):
        np.add(nodes[plan.left[a:b]], nodes[plan.right[a:b]], out=nodes[base + a : base + b])
    out = np.empty((len(plan.ids), width), np.int64)
    for i in range(len(plan.ids)):
        nodes[plan.links[plan.starts[i] : plan.starts[i + 1]]].sum(axis=0, out=out[i])
    return out


def _counted(texts: pd.Series, terms: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text its number of terms, and the known ones with their counts."""
    find = terms.get
    for text in texts:
        words = terms_of(text)
        known = [k for k in map(find, words) if k is not None]
        yield len(words), *np.unique(np.array(known, np.int64), return_counts=True)


def _statistics(docs: DataFrame, plan: Plan) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of the plan's terms, over all documents.

    One row per term comes back: the terms of a part of the queries."""
    sent = docs.sparkSession.sparkContext.broadcast(plan.terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, documents, length = np.zeros(len(sent.value), np.int64), 0, 0
        for batch in batches:
            for n, known, _ in _counted(batch["_text"], sent.value):
                documents += n > 0
                length += n
                df[known] += 1
        some = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.concatenate([[-1, -2], some]), "n": np.concatenate([[documents, length], df[some]])})

    rows = docs.select("_text").mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    df = np.zeros(len(plan.terms), np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    return found.get(-1, 0), found.get(-2, 0), df


class _Best:
    """The best ``top`` documents of every query so far: more score first, then the smaller id, null last."""

    def __init__(self, queries: int, top: int):
        self.top, self.least, self.waiting = top, np.ones(queries, np.int64), 0
        self.pool = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))]
        self.limit = max(200_000, 4 * queries * top)

    def add(self, found: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        query, place = np.nonzero(found >= self.least[:, None])
        self.pool.append((query, found[query, place], nulls[place], ids[place]))
        self.waiting += len(query)
        if self.waiting > self.limit:
            self.settle()

    def settle(self) -> tuple:
        query, score, null, ids = (np.concatenate(c) for c in zip(*self.pool))
        order = np.lexsort((ids, null, -score, query))
        query, score, null, ids = query[order], score[order], null[order], ids[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        at = np.flatnonzero(rank == self.top - 1)
        self.least[query[at]] = score[at]  # a tie with the last may still win by its id
        kept = rank < self.top
        self.pool, self.waiting = [(query[kept], score[kept], null[kept], ids[kept])], 0
        return self.pool[0]


def _ranked(docs: DataFrame, plan: Plan, top: int, cells: int) -> DataFrame:
    """``item, _id, score``: the best documents of every task."""
    n_docs, length, df = _statistics(docs, plan)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((plan, weight))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, weight = sent.value
        terms = len(plan.terms)
        most = max(int(np.diff(plan.starts).max(initial=0)), 2)
        width = max(1, cells // (terms + 3 * len(plan.left) + len(plan.ids) + most))
        best = _Best(len(plan.ids), top)
        for batch in batches:
            counted = _counted(batch["_text"], plan.terms)
            null = batch["_id"].isna().to_numpy()
            ids = batch["_id"].fillna(0).astype("int64").to_numpy()
            for a in range(0, len(batch), width):
                size = min(width, len(batch) - a)
                given = np.zeros((terms, size), np.int64)
                for k in range(size):
                    n, known, tf = next(counted)
                    m = 100 - 50 + (50 * n * n_docs) // length if length else 0
                    given[known, k] = weight[known] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                best.add(scores(plan, given), ids[a : a + size], null[a : a + size])
        query, score, null, ids = best.settle()
        own = pd.array([plan.ids[q] for q in query.tolist()], dtype="Int64")
        yield pd.DataFrame({"item": own, "_id": pd.Series(ids, dtype="Int64").mask(pd.Series(null)), "score": score})

    return docs.mapInPandas(run, "item long, _id long, score long")


def _parts(queries: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """``(id, terms)`` of the queries, in parts of about PART_CHARS characters, the same parts each time."""
    own = queries.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL").distinct()
    parts = -(-(own.agg(F.sum(F.length("t"))).first()[0] or 0) // PART_CHARS)
    for p in range(parts):
        found: dict = {}
        for r in own.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == p).collect():
            found.setdefault(r["i"], set()).update(terms_of(r["t"]))
        listed = sorted(((i, ts) for i, ts in found.items() if ts), key=lambda q: (q[0] is None, q[0] or 0))
        if listed:
            yield listed


def search(
    docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", cells: int = CELLS,
) -> DataFrame:
    """``item, rank, id, score``: the ``top`` documents of every query with a score above 0.

    Equal scores come by ascending id, a null id last.  Documents without terms (null, empty, blank) are found
    by no query and do not count as documents; queries without terms find nothing; rows of queries that repeat an id
    are one query with all their terms; rows of documents that repeat an id are documents of their own;
    very long texts are counted whole; further columns are left out; an empty table on either side gives an empty result.

    Queries travel to the documents in parts of bounded size, each with two reads of the corpus.  No document is
    shuffled: every task keeps its best ones, and these are merged in two steps."""
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = None
    for part in _parts(queries, item_col, item_text_col):
        ranked = _ranked(own, mine(part), top, cells)
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, _id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("_id")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)))
    first = Window.partitionBy("item", "_salt").orderBy(*order)
    merged = salted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    last = Window.partitionBy("item").orderBy(*order)
    merged = merged.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    return merged.select(F.col("item").alias(item_col), "rank", F.col("_id").alias(id_col), "score")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
