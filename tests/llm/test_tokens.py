import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltstone.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "Hello  world\n\tit's <|endoftext|> x<|startoftext|>y",
    " a b é é ́x İ ΑΣ Σ ﬁ",
    "日本語のテキスト 1234567 ... --- 😀😀",
    "x" * 5000,
    "don't I'LL we've\x0bv\x0cf\x1cq",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def count(plain, text):
    return len(plain.encode(text, add_special_tokens=False))


def test_query_matches_the_library(spark, sf, plain):
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = tokens.op7_tokens(spark, sf).collect()
    assert len(got) == len(given)
    for r in got:
        text = given[r["doc_id"]] or ""
        n = count(plain, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_every_prefix_is_exact(spark, plain):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").selectExpr("*", "0 AS prefix", "1 AS _id")
    got = tokens.prefix_counts(df, PATH)
    for r in got.collect():
        text = ODD[r["doc_id"]]
        words = text.encode().split()
        assert len(r["prefix"]) == len(words) + 1
        for i in range(len(words) + 1):
            assert r["prefix"][i] == count(plain, b" ".join(words[:i]).decode())
        assert r["prefix"][-1] == count(plain, text)
    three = got.select("doc_id", tokens.words_within("prefix", 3).alias("n"), tokens.tokens_between("prefix", 0, 1).alias("t"), "prefix").collect()
    for r in three:
        assert r["n"] == max(i for i, p in enumerate(r["prefix"]) if p <= 3) and r["t"] == r["prefix"][1]


def test_odd_rows(spark, docs, plain):
    got = {r["doc_id"]: r for r in tokens.budgets(docs, PATH, 100).collect()}
    assert tokens.budgets(docs, PATH, 100).count() == docs.count()
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == got[3]["n_tokens"] == 0
    assert got[4]["n_tokens"] == got[6]["n_tokens"] > 20_000 and got[4]["fit_words"] < 100
    assert tokens.budgets(docs.limit(0), PATH, 100).count() == 0
