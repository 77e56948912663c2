import tracemalloc

import numpy as np

from siltstone.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fitted = labels.where("pmod(xxhash64(doc_id), 4) > 0")
    got = {r["doc_id"]: r for r in quality.classify(docs, fitted).collect()}
    assert len(got) == docs.count()
    held = labels.where("pmod(xxhash64(doc_id), 4) = 0").collect()
    bad = [r for r in held if not r["quality"] or r["toxic"]]
    fine = [r for r in held if r["quality"] and not r["toxic"]]
    assert np.mean([not got[r["doc_id"]]["keep"] for r in bad]) >= 0.95
    assert np.mean([got[r["doc_id"]]["keep"] for r in fine]) >= 0.97


def test_em_finds_who_is_right():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.2
    votes = np.full((4000, 4), -1)
    for k, right in enumerate((0.95, 0.9, 0.85)):
        votes[:, k] = np.where(rng.random(4000) < right, truth, ~truth)
    votes[:400, 3] = truth[:400]
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post = quality.em(patterns, counts.astype(float))[at.ravel()]
    assert ((post > 0.5) == truth).mean() > 0.93


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 0), (5, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    more = docs.selectExpr("*", "1 AS junk", "2 AS _text")
    for given in (labels, labels.limit(0)):
        got = quality.classify(more, given)
        assert got.columns == ["doc_id", "junk", "toxic", "keep"] and got.count() == docs.count()
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.kept(more, labels.limit(0)).columns == more.columns


def test_what_a_worker_remembers_stays_small():
    """One small entry for each word, from the two passes over all texts: these live beside the JVM of an executor."""
    letters = "abcdefghijklmnopqrst"
    ends = [a + b for a in letters for b in letters]
    texts = [" ".join(f"word{a}{b}," for b in ends) for a in ends]
    model = quality.Model({1: 0.5}, -3.0, {quality.SHAPES + 1: 0.5}, -4.0)
    lexicons = quality.Lexicons([np.arange(3), np.arange(3)])
    tracemalloc.start()
    try:
        for text in texts:
            assert lexicons.votes(text) == [0, 0]
            assert model.scores(text) == model.scores(text)
        assert tracemalloc.get_traced_memory()[0] < 50e6
    finally:
        tracemalloc.stop()


def test_scores_are_the_weighted_features():
    text = "The THE the the x1, A-b the, a--b ünd ÜND!!"
    words = text.split()
    keys, shares = quality.shapes(words, quality.Counter(words))
    found = dict(zip(keys.tolist(), shares.tolist(), strict=True)) | dict.fromkeys(quality.lexical(text).tolist(), 1.0)
    weights = {k: 0.1 + 0.01 * n for n, k in enumerate(sorted(found)) if n % 2}
    z = sum(w * found[k] for k, w in sorted(weights.items())) - 1
    model = quality.Model(weights, -1.0, {}, 2.0)
    for _ in range(2):  # the second time from memory
        assert np.allclose(model.scores(text), [1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-2.0))])
