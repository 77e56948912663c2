import random
import re

import numpy as np
import pytest

from siltstone.llm import jaccard


def shingle_set(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not found:
        return set()
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def brute(rows, words=5, percent=80):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(((i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets)), key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_all_pairs(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = answer(jaccard.op6_jaccard(spark, sf))
    assert got == brute(rows)
    assert any(i != c for i, _, c in got)


@pytest.mark.parametrize("rounds", [1, 2])
def test_copies_edits_and_thresholds(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 4)
    rng = random.Random(rounds)
    pool = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 90))] for _ in range(8)]
    texts = []
    for _ in range(150):
        w = list(rng.choice(pool))
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice([[], [f"z{rng.randrange(9)}"]])
        texts.append(" ".join(w) if rng.random() < 0.8 else "\n".join(w).upper())
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{passage} " + " ".join(f"q{k}_{i}" for i in range(9)) for k in range(12)]
    # Exactly at, and just below, four of five: 8 of 10 and 11 of 14 shingles.
    texts += [" ".join("abcdefghijklm"), " ".join("abcdefghijkl" + "X"), " ".join("0123456789ABCDEF"), " ".join("0123456789ABCDxyz")]
    texts += [None, "", "  ", "a b", "A  b", "a b c", "É a b c d", "é a b c d"]
    rows = [(int(i), t) for i, t in zip(rng.sample(range(1000), len(texts)), texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _n", "2 AS component_id")
    assert answer(jaccard.jaccard_groups(df)) == brute(rows)


def test_odd_rows(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert answer(jaccard.jaccard_groups(docs)) == brute(rows)
    assert jaccard.jaccard_groups(docs.limit(0)).count() == 0


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        bound = jaccard.most_overlap(len(a), jaccard.signature(a), len(b), jaccard.signature(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_one_row_of_a_group_of_copies_stays(spark):
    """Rows that repeat id and text are copies too, and a row without an id never stands for one that has it."""
    text = "one two three four five six seven"
    rows = [(None, text, i) for i in range(4)] + [(7, text, i) for i in range(3)] + [(8, text, 0), (9, "", 1), (9, "", 2), (None, "quite another text", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rank int").selectExpr("*", "1 AS _k1", "2 AS _row", "3 AS _words", "4 AS _n")
    got = jaccard.representatives(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r._rank) for r in got.collect()) == [(0, "quite another text", 5), (7, text, 0), (9, "", 1), (9, "", 2)]
