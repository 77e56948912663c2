import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators.asof import asof_join

T0 = datetime(2024, 1, 1)
HISTORY = "k string, j int, a string, __START_AT timestamp_ntz, __END_AT timestamp_ntz"


def at(h):
    return None if h is None else T0 + timedelta(hours=h)


def plain(facts, versions):
    out = []
    for k, j, t, n in facts:
        hit = [v for v in versions if None not in (k, j, t, v[3]) and v[:2] == (k, j) and v[3] <= t and (v[4] is None or t < v[4])]
        assert len(hit) <= 1
        out.append((n, hit[0][2] if hit else None, hit[0][3] if hit else None))
    return sorted(out, key=str)


def case(seed=1, facts=600):
    rng = random.Random(seed)
    versions = []
    for key in range(12):
        starts = sorted(rng.sample(range(200), 2 + key * 4))
        for i, s in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else None
            if end is not None and rng.random() < 0.3:
                end -= (end - s) // 2  # a gap before the next version
            if rng.random() < 0.9:
                versions.append((f"k{key}", key % 2, f"a{s}", at(s), at(end)))
    versions += [("k1", 1, "none", None, None), (None, 1, "x", at(0), None)]
    asked = [(f"k{rng.randrange(13)}", rng.randrange(2), at(rng.randrange(-5, 210)), i) for i in range(facts)]
    asked += [(None, 1, at(5), 9001), ("k1", None, at(5), 9002), ("k1", 1, None, 9003)] + [("k3", 1, at(3), 9004)] * 3
    return asked, versions


@pytest.mark.parametrize("floor", [None, 5, 80])
def test_equals_the_plain_join(spark, floor):
    asked, versions = case()
    asked += [("k11", 1, at(i % 230 - 10), 20_000 + i) for i in range(900)]  # a hot key
    facts = spark.createDataFrame(asked, "who string, j int, t timestamp_ntz, n int")
    history = spark.createDataFrame(versions, HISTORY)
    got = asof_join(facts, history, [("who", "k"), "j"], "t", prefix="v_", split_floor=floor)
    assert got.columns == ["who", "j", "t", "n", "v_a", "v___START_AT", "v___END_AT"]
    assert sorted(((r.n, r.v_a, r["v___START_AT"]) for r in got.collect()), key=str) == plain(asked, versions)
    inner = asof_join(facts, history, [("who", "k"), "j"], "t", "inner", "v_", floor)
    assert sorted(((r.n, r.v_a, r["v___START_AT"]) for r in inner.collect()), key=str) == [r for r in plain(asked, versions) if r[2] is not None]


def test_one_shuffle_and_no_pairing(spark):
    facts = spark.createDataFrame([("k1", 1, at(1))], "k string, j int, t timestamp_ntz")
    text = asof_join(facts, spark.createDataFrame([], HISTORY), ["k", "j"], "t")._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Initial Plan ==")[0]
    assert text.count("Exchange ") == 1 and "Join" not in text


def test_empty_sides_and_clashes(spark):
    facts = spark.createDataFrame([("k1", 1, at(1))], "k string, j int, t timestamp_ntz")
    history = spark.createDataFrame([], HISTORY)
    assert [tuple(r) for r in asof_join(facts, history, ["k", "j"], "t").collect()] == [("k1", 1, at(1), None, None, None)]
    assert asof_join(facts.limit(0), history, ["k", "j"], "t").count() == 0
    with pytest.raises(ValueError, match="both sides have a"):
        asof_join(facts.withColumn("a", F.lit(1)), history, ["k", "j"], "t")
    with pytest.raises(ValueError, match="how"):
        asof_join(facts, history, ["k", "j"], "t", "outer")
