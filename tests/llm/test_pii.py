import hashlib
import re

from siltstone.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True,
        "ip": all(int(p) <= 255 for p in match.split(".")) if kind == "ip" else False,
        "card": 16 <= len(digits) <= 19 and luhn(digits),
        "phone": 8 <= len(digits) <= 15,
    }[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if fine(k, m.group())]


ODD = [
    "a@b.c_d@e.f x@y z@q.r.s.t. é😀 me+you@host-1.org",
    "@@a@b..c d@-.- 1a@b@c.d",
    "1.2.3.4.5 300.1.1.1.1 999.1.1.1 001.002.003.255 10.0.0.256 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111-0 5500005555555559x 12 4111  1111 11 4111111111111111 4111111111111111",
    "+49 (0) 30 123456 +1-2 +12345678 +1234567890123456 +4930123456- ++4930123456",
    "1" * 30_000 + " " + "a" * 30_000 + "@" + "b." * 2000,
    "-4111111111111111 4-4111111111111111 ٣4111111111111111",
    "+1 " + "(" * 20_000 + "5555555555",
]


def test_spans_match_plain_search(spark):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "", "   "])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS _text")
    kinds = pii.BASE
    found = {r["doc_id"]: r["t"] for r in pii.find_pii(df, kinds=kinds).select("doc_id", pii.as_text(pii.F.col("spans")).alias("t")).collect()}
    for i, text in rows:
        assert found[i] == ",".join(brute(text)), i


def test_very_many_matches_in_one_text(spark):
    text = "é " + " ".join(f"name{i}@host{i}.org and 10.0.{i % 300}.7," for i in range(20_000))
    got = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string"), kinds=pii.BASE)
    assert got.select(pii.as_text(pii.F.col("spans")).alias("t")).first()["t"] == ",".join(brute(text))


def test_context_goes_past_other_matches(spark):
    """The word before the first address still stands within reach of the second."""
    rows = [(1, "mail a@b.cd e@f.gh"), (2, "mail " + "x" * 40 + " a@b.cd")]
    got = {r["doc_id"]: [s["score"] for s in r["spans"]] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [0.9, 0.9], 2: [0.6]}


def test_query_matches_plain_search(spark, sf):
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in pii.op3_pii(spark, sf).collect()}
    assert len(found) == len(given)
    for r in given:
        spans = brute(r["text"])
        assert found[r["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        for kind in BASE:
            assert found[r["doc_id"]][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)
        assert [s for s in found[r["doc_id"]]["spans"].split(",") if s.split(":")[0] in BASE] == spans


def test_checksums_and_context(spark):
    rows = [
        (1, "transfer to DE89 3704 0044 0532 0130 00 today"),
        (2, "transfer to DE88 3704 0044 0532 0130 00 today"),
        (3, "number 378282246310005"),
        (4, "my amex card 378282246310005"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find_pii(df).collect()}
    assert got == {1: ["iban"], 2: [], 3: [], 4: ["card_short"]}
    scores = {r["doc_id"]: [s["score"] for s in r["spans"]] for r in pii.find_pii(df).collect()}
    assert scores[1] == [1.0] and scores[4] == [0.6]


def test_masking(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd or +49 30 1234567."), (2, None), (3, "nothing")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    assert got == {1: "mail [email] or [phone].", 2: "", 3: "nothing"}


def test_odd_rows(spark, docs):
    assert pii.find_pii(docs).count() == docs.count()
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = pii.op3_pii(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
