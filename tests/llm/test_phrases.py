import random
import re
from collections import Counter, defaultdict

import pytest

from siltstone.llm import phrases
from siltstone.llm.oracle import ORACLE
from siltstone.llm.phrases import Settings, collocations, frequent, op12_phrases
from tests.compare import connect, differences


def counted(rows):
    """Counts of every phrase of every language, and the words."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                f[lang].update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def plain(rows, top, least):
    f, n = counted(rows)
    out = []
    for lang, count in f.items():
        chosen = {p: c for p, c in count.items() if c >= least and " " in p}
        ranked, around = [], Counter()
        for q, c in chosen.items():
            w = q.split(" ")
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    if j - i < len(w):
                        around[" ".join(w[i:j])] = max(c, around[" ".join(w[i:j])])
        for p, a in chosen.items():
            w = p.split(" ")
            best = min(
                (1000 * a * n[lang] // (count[" ".join(w[:k])] * count[" ".join(w[k:])]), k) for k in range(1, len(w))
            )
            if around[p] < a:
                k = best[1]
                ranked.append((-best[0], -a, p.encode(), count[" ".join(w[:k])], count[" ".join(w[k:])]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def corpus(seed=1, docs=300):
    rng = random.Random(seed)
    idioms = [["new", "york"], ["Über", "den", "wolken"], ["a", "a", "a"], ["one", "two", "three", "four", "five", "six"], ["x\x00y", "z\x1c"]]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randrange(60)):
            words += rng.choice(idioms) if rng.random() < 0.2 else [f"W{int(rng.paretovariate(0.7)) % 50}"]
            words.append(rng.choice(["", "", "", "", ".", ",", "\n", "\t", " \t ", "?!"]))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und"]), " ".join(words)))
    return rows


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(connect(sf), op12_phrases(spark, sf), ORACLE["op12_phrases"]) is None


@pytest.mark.parametrize("least,top", [(20, 2000), (4, 2000), (4, 7)])
def test_equals_counting_everything(spark, least, top):
    rows = corpus()
    df = spark.createDataFrame([(i // 2, *r, 1, 2) for i, r in enumerate(rows)], "doc_id long, lang string, text string, a int, score int").repartition(5)
    assert found(collocations(df, top, least)) == plain(rows, top, least)


def test_a_sample_that_proposes_nothing(spark, monkeypatch):
    """The border alone finds everything, in as many passes as the longest phrase has words."""
    passes = []
    real = phrases._counted
    monkeypatch.setattr(phrases, "_counted", lambda *a: passes.append(1) or real(*a))
    rows = corpus(2, 150)
    df = spark.createDataFrame(rows, "lang string, text string")
    none = Settings(sample=10**9, entries=50, chunk_bytes=500)
    assert found(collocations(df, 2000, 5, given=none)) == plain(rows, 2000, 5)
    assert len(passes) == 5


@pytest.mark.parametrize("given", [Settings(bits=10), Settings(words=10, chunk_bytes=300), Settings(sample=1, buckets=3), Settings(sample=50, entries=1)])
def test_settings_change_nothing(spark, given):
    rows = corpus(3, 100)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(collocations(df, 2000, 3, given=given)) == plain(rows, 2000, 3)


def test_odd_rows(spark, docs):
    df = docs.selectExpr("*", "CASE WHEN doc_id = 5 THEN 'en' END AS lang")
    rows = [(r.lang, r.text) for r in df.collect()]
    assert found(collocations(df, 2000, 2)) == plain(rows, 2000, 2)
    assert collocations(df.limit(0)).collect() == []
    totals = {r.lang: r.f for r in frequent(df.selectExpr("coalesce(lang, 'und') AS _lang", "coalesce(text, '') AS _text"), 2).where("size = 0").collect()}
    assert totals == dict(counted(rows)[1])
