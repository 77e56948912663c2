import random

import numpy as np

from siltstone.llm import leaks


def plain(item, text):
    """Smith-Waterman, cell by cell: best score."""
    best, row = 0, [0] * (len(text) + 1)
    for x in item:
        new = [0]
        for j, y in enumerate(text, 1):
            step = leaks.MATCH if x == y else leaks.MISMATCH
            new.append(max(0, row[j - 1] + step, row[j] + leaks.GAP, new[-1] + leaks.GAP))
        row = new
        best = max(best, *row)
    return best


def test_alignment_matches_the_plain_one():
    rng = random.Random(2)
    for _ in range(150):
        a = np.array([rng.randrange(1, 6) for _ in range(rng.randrange(1, 20))])
        b = np.array([rng.randrange(0, 6) for _ in range(rng.randrange(1, 40))])
        score, first, end = leaks.align(a, b)
        assert score == plain(a.tolist(), b.tolist())
        if score:
            assert plain(a.tolist(), b[first:end].tolist()) == score


def test_query_finds_all_whole_items(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]): r for r in leaks.op2_leaks(spark, sf).collect()}
    want = set()
    for d in docs:
        text = f" {' '.join(leaks.words_of(d['text'] or ''))} "
        for i in items:
            passage = f" {' '.join(leaks.words_of(i['text']))} "
            if passage in text:
                want.add((d["doc_id"], i["item_id"]))
                assert got[d["doc_id"], i["item_id"]]["score"] == 1.0
    assert want and all(got[k]["score"] < 1 for k in got.keys() - want)


def test_edits_and_odd_rows(spark, docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    item = [rng.choice(words) for _ in range(40)]
    edited = [w if k % 6 else f"other{k}" for k, w in enumerate(item)]
    dropped = [w for k, w in enumerate(item) if k % 7]
    filler = lambda: [f"f{rng.randrange(10**6)}" for _ in range(50)]
    rows = [(1, filler() + item + filler()), (2, filler() + edited), (3, dropped + filler()), (4, filler()), (5, item[:12] + filler())]
    df = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in rows] + [(6, None), (7, ""), (1, " ".join(rows[0][1]))], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS item_id")
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (4, "f1 f2"), (None, " ".join(item))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or -1, r["score"] == 1, r["first_word"]) for r in leaks.leaks(df, bench).collect())
    assert [g[:3] for g in got] == sorted([(1, 1, True), (1, -1, True), (1, 1, True), (1, -1, True), (2, 1, False), (2, -1, False), (3, 1, False), (3, -1, False)])
    assert {g[3] for g in got if g[0] == 1} == {50}
    assert sorted(r["doc_id"] for r in leaks.clean(df, bench).collect()) == [4, 5, 6, 7]
    assert leaks.clean(df, bench).columns == df.columns
    assert leaks.leaks(df.limit(0), bench).count() == leaks.leaks(df, bench.limit(0)).count() == 0
    assert leaks.clean(df, bench.limit(0)).count() == df.count()
    assert leaks.leaks(docs, bench).count() == 0


def test_items_in_several_parts(spark, sf, monkeypatch):
    whole = sorted(map(tuple, leaks.op2_leaks(spark, sf).collect()))
    monkeypatch.setattr(leaks, "PART_CHARS", 2500)
    assert sorted((r[0], r[1]) for r in leaks.op2_leaks(spark, sf).collect()) == [(w[0], w[1]) for w in whole]
