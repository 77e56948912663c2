import math
import re
from collections import Counter

import numpy as np

from siltstone.llm import ranked
from siltstone.llm.oracle import ORACLE
from siltstone.llm.ranked import mine, op11_search, scores, search
from tests.compare import connect, differences


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, top):
    """Every document scored for every item."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, c in counted:
            total = 0
            for t in terms & set(c):
                m = 50 + 50 * sum(c.values()) * n_docs // length
                total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if total > 0:
                found.append((-total, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_sql(spark, sf):
    assert differences(connect(sf), op11_search(spark, sf), ORACLE["op11_search"]) is None


def test_odd_rows(spark, docs):
    more = [(7, "É é E e _x_ two\x00two\x7f two", "n"), (8, "TWO two", "n"), (9, "two two", "n"), (None, "two two", "n"), (10, "one, THREE", "n")]
    df = docs.selectExpr("*", "'x' AS score").unionByName(spark.createDataFrame(more, "doc_id long, text string, score string"))
    items = [(1, "two É"), (1, "three"), (2, None), (3, "..."), (4, "w5x5 w6x6 w7x7 two"), (4, "w5x5 w6x6 w7x7 two"), (None, "two one one"), (5, "nowhere")]
    queries = spark.createDataFrame([(*i, "r") for i in items], "item_id long, text string, rank string")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for top in (1, 2, 50):
        assert found(search(df, queries, top)) == plain(rows, [i for i in items if plain_terms(i[1])], top)
    assert search(df.limit(0), queries).collect() == [] == search(df, queries.limit(0)).collect()


def test_parts_and_small_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda: f"w{int(rng.zipf(1.3)) % 300}"
    rows = [(i // 2, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for i in range(400)] + [(1000, "w1 w2 w3 " * 300)] * 5
    items = [(i, " ".join(word() for _ in range(20))) for i in range(30)]
    docs, queries = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain(rows, items, 50)
    assert found(search(docs.repartition(7), queries)) == want
    monkeypatch.setattr(ranked, "PART_CHARS", 500)
    assert found(search(docs.repartition(3), queries, cells=500)) == want


def test_the_graph_shares_work():
    """Queries over a shared graph: fewer additions than term by term, the same sums."""
    rng = np.random.default_rng(5)
    common = [{f"c{k}_{j}".encode() for j in range(8)} for k in range(6)]
    queries = []
    for i in range(40):
        own = {f"t{int(rng.integers(400))}".encode() for _ in range(10)}
        queries.append((i, own.union(*(common[k] for k in rng.choice(6, 2, replace=False)))))
    plan = mine(queries)
    assert len(plan.levels) > 3
    assert len(plan.links) + len(plan.left) < 0.6 * sum(len(ts) for _, ts in queries)
    given = rng.integers(0, 10**12, (len(plan.terms), 17))
    direct = np.array([given[[plan.terms[t] for t in ts]].sum(axis=0) for _, ts in queries])
    assert (scores(plan, given) == direct).all()
