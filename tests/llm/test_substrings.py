import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import common, substrings


def brute(texts, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        lost = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                lost.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in lost)
        out.append((len(w), len(lost), kept))
    return out


def test_query_matches_plain_search(spark, sf):
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(given, brute([r["text"] for r in given]), strict=True)}
    got = substrings.op10_substrings(spark, sf).collect()
    assert len(got) == len(given)
    for r in got:
        n, lost, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, lost, hashlib.sha256(kept.encode()).hexdigest())
    assert sum(r["n_removed"] for r in got) > 0


@pytest.mark.parametrize(("window", "gram"), [(35, 12), (5, 2), (7, 7), (4, 1)])
def test_copied_stretches(spark, window, gram):
    rng = random.Random(window)
    pool = [[f"w{rng.randrange(6)}" for _ in range(rng.randrange(5, 120))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts += p[a : a + rng.randrange(1, 80)] + [f"u{rng.randrange(40)}" for _ in range(rng.randrange(0, 12))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
    texts += ["a " * 200, "a " * 200, None, "", " ", "é " * 50 + "b", texts[0], texts[0]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS _a")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.strip_repeats(df, window=window, gram=gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_odd_rows(spark, docs):
    got = substrings.strip_repeats(docs).collect()
    assert len(got) == docs.count()
    assert {r["n_removed"] for r in got if r["doc_id"] in (4, 6)} == {20_000}
    assert {r["n_removed"] for r in got if r["doc_id"] not in (4, 6)} == {0}
    assert substrings.strip_repeats(docs.limit(0)).count() == 0


def test_repeated_rows_are_copies(spark):
    text = " ".join(f"x{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (2, text + "y")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in substrings.strip_repeats(df).collect()) == [(1, 50), (1, 50), (2, 49)]


def test_spans_name_the_removed_words(spark):
    text = " ".join(f"x{i}" for i in range(40))
    df = spark.createDataFrame([(1, "p q " + text + " r"), (2, text + " s t")], "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in substrings.strip_repeats(df).collect()} == {1: [2, 42], 2: [0, 40]}


def test_least_positions():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 300).astype(np.uint64)
    for width in (1, 2, 5, 24):
        want = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert substrings.least_positions(values, width).tolist() == want


def test_run_hashes_tell_runs_apart():
    hashes = common.word_hashes([b"a", b"b", b"a", b"b", b"b", b"a", b"b"])
    for n in (1, 2, 3, 5):
        got = common.run_hashes(hashes, n)
        runs = [tuple(hashes[i : i + n]) for i in range(len(hashes) - n + 1)]
        assert len(got) == len(runs)
        assert all((got[i] == got[j]) == (runs[i] == runs[j]) for i in range(len(runs)) for j in range(len(runs)))
