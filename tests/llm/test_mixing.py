import re

import pytest

from siltstone.llm import mixing


def levels(sizes):
    """Targets by repeated sharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = float(sum(sizes.values())), dict.fromkeys(sizes, 0.0), set(sizes)
    while open_ and left > 1e-9:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit >= 3 * sizes[s]}
        if not full:
            for s in open_:
                target[s] = weight[s] * unit
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def checked(rows, got, near):
    sizes, taken = {}, {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = levels(sizes)
    by_id = {}
    for i, source, text in rows:
        by_id.setdefault(i, []).append((source, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    assert len(got) == len(rows)
    for r in got:
        source, size = by_id[r["doc_id"]][0]
        assert r["size"] in {n for _, n in by_id[r["doc_id"]]} and 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        taken[source] = taken.get(source, 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(near * t, 1 + sizes[s] / 64, 64), (s, taken[s], t)


def test_query(spark, sf):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = mixing.op9_mix(spark, sf).collect()
    checked(rows, got, 0.01)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op9_mix(spark, sf).collect()))


ROWS = [(i, "big", "a b c d e " * (i % 7)) for i in range(300)]
ROWS += [(1000 + i, "é" if i % 2 else None, "x " * 11) for i in range(20)]
ROWS += [(2000, "tiny", "w"), (2001, "none", None), (2002, "none", ""), (2003, "none", " \n "), (2004, "long", "v " * 30_000), (2005, "B", "q " * 40), (2005, "B", "q " * 40)]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, source string, text string").selectExpr("*", "1 AS _size", "2 AS target")


def test_hot_sources_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 100)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 7)
    checked(ROWS, mixing.mix(frame(spark)).collect(), 0.01)
    assert mixing.mix(frame(spark).limit(0)).count() == 0


def test_the_blocks_hold_the_words_taken(spark):
    df = frame(spark)
    taken = sum(r["taken"] for r in mixing.mix(df).collect())
    blocks = mixing.mixed_blocks(df).collect()
    assert sum(len(b["words"].split()) for b in blocks) == taken
    assert {b["source"] for b in blocks} == {"big", "é", None, "tiny", "long", "B"}
    assert len({(b["source"], b["slot"]) for b in blocks}) == len(blocks)


def test_permutation_covers_all_blocks(spark):
    plan = spark.createDataFrame([("a", 1000, 3000.0, 16, 48, 1), ("b", 1000, 500.0, 10, 5, 1)], "_source string, _total long, _target double, _blocks long, _slots long, _buckets long")
    got = mixing.draws(plan).collect()
    for source, blocks, slots in (("a", 16, 48), ("b", 10, 5)):
        taken = [r["_block"] for r in sorted(got, key=lambda r: r["_slot"]) if r["_source"] == source]
        assert len(taken) == slots
        for at in range(0, slots, blocks):
            part = taken[at : at + blocks]
            assert len(set(part)) == len(part) and set(part) <= set(range(blocks))


def test_one_document_that_repeats_very_often(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    monkeypatch.setattr(mixing, "COPIES", 16)
    rows = [(1, "hot", "a b c d e f g")] * 900 + [(2 + i, "other", "x y " * 9) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    checked(rows, mixing.mix(df).collect(), 0.01)
    sized = mixing.sized(df, "doc_id", "text", "source")
    placed = mixing.offsets(sized, mixing.targets(sized)).where("_source = 'hot'")
    assert sorted(r["_at"] for r in placed.collect()) == [7 * i for i in range(900)]


def test_counts_per_shard_are_a_multinomial_draw(spark, monkeypatch):
    """Pearson's statistic over the shards lies where that of a multinomial does; the totals are those planned."""
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 400)
    plan = spark.createDataFrame([("a", 0, 0.0, 30_000, 30_000, 1), ("b", 0, 0.0, 9_000, 10_000, 1)], "_source string, _total long, _target double, _blocks long, _slots long, _buckets long")
    for seed in (0, 1):
        got = mixing.draws(plan, seed).groupBy("_source", "_shard").count().collect()
        for source, slots in (("a", 30_000), ("b", 10_000)):
            counts = [r["count"] for r in got if r["_source"] == source]
            assert sum(counts) == slots and len(counts) == 100
            mean = slots / 100
            assert 55 < sum((n - mean) ** 2 / mean for n in counts) < 155  # 99 degrees of freedom


def test_no_python_in_the_plan(spark, sf):
    plan = mixing.op9_mix(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
