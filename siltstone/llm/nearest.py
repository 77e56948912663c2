"""Nearest neighbours by inner product: one vantage-point tree per shard of the vectors.

Vectors are lifted so that distance and inner product order alike: with M the largest norm, x becomes
(x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0); then |q - x|^2 = |q|^2 + M^2 - 2 q.x, a metric to
which the triangle inequality applies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import stored, table

SHARD_ROWS, QUERY_ROWS, LEAF = 4096, 512, 64


@dataclass
class Tree:
    """A vantage-point tree over rows ``order``.  Node i splits [lo, hi) of the order: its vantage
    point ``point[i]``, and for each child the least and greatest distance to that point."""

    order: np.ndarray
    nodes: list[tuple]  # (lo, hi, point, children); a child is (node, least, greatest)


def _distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((rows - point) ** 2).sum(axis=1), 0.0))


def build(lifted: np.ndarray) -> Tree:
    order, nodes = np.arange(len(lifted)), []

    def split(lo: int, hi: int) -> int:
        at = len(nodes)
        nodes.append((lo, hi, -1, ()))
        if hi - lo <= LEAF:
            return at
        rows = order[lo:hi]
        # The vantage point is the row farthest from the first: corners split better than the middle.
        point = rows[int(np.argmax(_distances(lifted[rows], lifted[rows[0]])))]
        far = _distances(lifted[rows], lifted[point])
        by = np.argsort(far, kind="stable")
        order[lo:hi], far = rows[by], far[by]
        if far[-1] == 0:  # equal vectors only: nothing to tell apart
            return at
        half = (hi - lo) // 2
        parts = ((lo, lo + half, far[0], far[half - 1]), (lo + half, hi, far[half], far[-1]))
        nodes[at] = (lo, hi, int(point), tuple((split(a, b), least, most) for a, b, least, most in parts))
        return at

    split(0, len(lifted))
    return Tree(order, nodes)


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in order, in double precision: equal vectors get equal scores."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def search(tree: Tree, vectors: np.ndarray, lifted: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> Iterator[tuple]:
    """For each query the places and scores of its ``k`` best rows of the shard (ties: smaller id), without the id ``own``.

    All queries go down together.  A node is left out for a query when its distance bound, times
    ``factor``, is beyond the query's k-th best so far; 1 is exact, more is faster and loses some."""
    n, count = len(queries), len(ids)
    asked = np.hstack([queries, np.zeros((n, 1))])
    norms = (queries**2).sum(axis=1)
    top = (lifted[0] ** 2).sum()
    # Rows with a query's own id (sorted, so side by side) may be among its best and don't count.
    mine = np.searchsorted(ids, own, "right") - np.searchsorted(ids, own, "left")
    keep = min(k + int(mine.max(initial=0)), count)
    # Rounding slack: bounds and block products may be off by some units in the last place.
    slack = 1e-9 * (1.0 + np.sqrt(norms.max(initial=0.0) * top) + top + norms.max(initial=0.0))
    best = np.full((n, keep), -np.inf)  # products, unordered
    rows = np.full((n, 0), -1)
    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    bound = np.zeros((n, len(tree.nodes)))
    stack = [0]
    while stack:
        at = stack.pop()
        lo, hi, point, children = tree.nodes[at]
        kth = best.min(axis=1)
        limit = np.sqrt(np.maximum(norms + top - 2 * kth, 0.0))  # inf until k were seen
        active = np.flatnonzero(~(bound[:, at] * factor > limit + np.sqrt(slack)))
        if not len(active):
            continue
        if not children:
            members = tree.order[lo:hi]
            products = queries[active] @ vectors[members].T
            merged = np.hstack([best[active], products])
            best[active] = np.partition(merged, merged.shape[1] - keep, axis=1)[:, -keep:]
            close = products >= best[active].min(axis=1)[:, None] - slack
            for i, row in enumerate(active):
                if close[i].any():
                    found[row].append(members[close[i]])
            continue
        away = np.sqrt(np.maximum(norms[active] + top - 2 * (queries[active] @ vectors[point]), 0.0)) if point >= 0 else None
        for child, least, most in children:
            outside = np.maximum(away - most, least - away)
            bound[active, child] = np.maximum(bound[active, at], outside)
            idle = np.setdiff1d(np.arange(n), active, assume_unique=True)
            bound[idle, child] = np.inf
        # The child nearer to most queries first, so that limits tighten early.
        stack.extend(sorted((c for c, _, _ in children), key=lambda c: -bound[active, c].sum()))
    del rows, asked
    for i in range(n):
        near = np.concatenate(found[i]) if found[i] else np.zeros(0, int)
        near = near[ids[near] != own[i]]
        scores = _exact(vectors[near], queries[i])
        first = np.lexsort((ids[near], -scores))[:k]
        yield near[first], scores[first]


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id and vector as doubles; rows whose id or vector is null, or whose vector is all zero or
    has a null or non-finite component, are left out: they take no part."""
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("_id"), vector.alias("_v"))
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("_v", lambda x: x != 0)
    return rows.where(F.col("_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _norm2():
    return F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, dict[int, float]]:
    """All vectors packed into shards ``_dim, _shard, _ids, _vectors, _copies, _order, _nodes`` of about ``SHARD_ROWS`` rows,
    each with its tree, and the largest norm per number of components (vectors of unlike
    lengths are never compared).  Rows with equal ids and vectors are one row with their number in ``_copies``."""
    rows = valid(df, id_col, vector_col).groupBy("_id", "_v").agg(F.count("*").alias("_n"))
    rows = stored(rows, "vectors")
    sizes = rows.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n"), F.max(_norm2()).alias("m")).collect()
    counts = {r["d"]: r["n"] for r in sizes}  # as many entries as there are vector lengths
    shards = F.coalesce(*[F.when(F.size("_v") == d, -(-n // SHARD_ROWS)) for d, n in counts.items()], F.lit(1))
    dealt = rows.withColumn("_dim", F.size("_v")).withColumn("_shard", F.pmod(F.xxhash64("_id", "_v"), shards).cast("int"))
    greatest = {r["d"]: float(np.sqrt(r["m"])) for r in sizes}

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id", kind="stable")
        ids, vectors, copies = pdf["_id"].to_numpy(np.int64), np.stack(pdf["_v"].to_numpy()), pdf["_n"].to_numpy(np.int64)
        tree = build(_lift(vectors, greatest[key[0]]))
        flat = np.array([[lo, hi, p, *(x for c in (ch or ((-1, 0, 0),) * 2) for x in c)] for lo, hi, p, ch in tree.nodes], np.float64)
        return pd.DataFrame([[*key, ids.tobytes(), vectors.tobytes(), copies.tobytes(), tree.order.astype(np.int64).tobytes(), flat.tobytes()]], columns=_INDEX)

    schema = "_dim int, _shard int, _ids binary, _vectors binary, _copies binary, _order binary, _nodes binary"
    return dealt.groupBy("_dim", "_shard").applyInPandas(pack, schema), greatest


_INDEX = ["_dim", "_shard", "_ids", "_vectors", "_copies", "_order", "_nodes"]


def _lift(vectors: np.ndarray, greatest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(greatest**2 - (vectors**2).sum(axis=1), 0.0))
    return np.hstack([vectors, rest[:, None]])


def _tree(order: bytes, nodes: bytes) -> Tree:
    rows = np.frombuffer(nodes, np.float64).reshape(-1, 9)
    unpacked = []
    for r in rows:
        children = tuple((int(r[j]), r[j + 1], r[j + 2]) for j in (3, 6) if r[j] >= 0)
        unpacked.append((int(r[0]), int(r[1]), int(r[2]), children))
    return Tree(np.frombuffer(order, np.int64), unpacked)


def nearest(df: DataFrame, queries: DataFrame, k: int, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` rows of ``df`` with the
    largest inner product, the query's own id left out; ties to smaller ids.

    ``factor`` relaxes the pruning (see ``search``); 1 restores the exact search.  Vectors that are
    null, zero or hold a null or non-finite component take no part on either side; fewer than ``k``
    candidates are all returned; empty tables give an empty result; further columns are left out.
    Rows of ``df`` that repeat are candidates each, as often as they stand there; rows with the query's id are
    none of its candidates.  A query row that repeats is answered once; an id with several vectors is as many queries, each with
    ranks of its own.

    Each task searches one block of at most about ``QUERY_ROWS`` queries in one shard, so its memory does not depend
    on the tables.  Work is queries times vectors in the worst case, as any exact search."""
    index, greatest = build_index(df, id_col, vector_col)
    index = stored(index, "shards")
    asked = valid(queries, id_col, vector_col).withColumn("_dim", F.size("_v"))
    # As many blocks as the queries need; the count is one number.
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64(F.col("_id") + 1), F.lit(blocks)).cast("int")).groupBy("_dim", "_block").agg(F.collect_set(F.struct("_id", "_v", F.xxhash64("_v").alias("_m"))).alias("_asked"))
    pairs = index.join(asked, "_dim").repartition(F.col("_dim"), F.col("_shard"), F.col("_block"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                vectors = np.frombuffer(r.vectors, np.float64).reshape(len(ids), r.dim)
                own = np.array([a["_id"] for a in r.asked], np.int64)
                q = np.array([a["_v"] for a in r.asked], np.float64).reshape(len(own), r.dim)
                lifted = _lift(vectors, greatest[r.dim])
                found = search(_tree(r.order, r.nodes), vectors, lifted, ids, q, own, k, factor)
                copies, marks = np.frombuffer(r.copies, np.int64), [a["_m"] for a in r.asked]
                out = [
                    (o, m, ids[i], s, min(copies[i], k))
                    for o, m, (near, scores) in zip(own, marks, found, strict=True)
                    for i, s in zip(near, scores, strict=True)
                ]
                kinds = {"query_id": "int64", "mark": "int64", "vec_id": "int64", "score": "float64", "n": "int64"}
                yield pd.DataFrame(out, columns=list(kinds)).astype(kinds)

    pairs = pairs.select(*[F.col(f"_{c}").alias(c) for c in ("dim", "ids", "vectors", "copies", "order", "nodes", "asked")])
    local = pairs.mapInPandas(run, "query_id long, mark long, vec_id long, score double, n long")
    # More than k copies of a row can't all be among the k best.
    local = local.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours that were found."""
    hits = exact.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, exact.count())


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector, exactly (factor one)."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)
