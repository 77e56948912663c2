import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltstone.operators import history
from siltstone.operators.history import as_of, current, scd1, scd2

T0 = datetime(2024, 1, 1)


def at(n):
    return T0 + timedelta(hours=n)


FEED = "k string, seq timestamp_ntz, id int, a string, b string, op string"
ARGS = dict(deletes="op = 'D'", except_columns=["id", "op"])


def frame(spark, rows):
    return spark.createDataFrame([(k, at(n), i, a, b, op) for k, n, i, a, b, op in rows], FEED)


def versions(df, *columns):
    return sorted(
        ((r.k, *(r[c] for c in columns), r["__START_AT"], r["__END_AT"]) for r in df.collect()), key=lambda v: (v[0], v[-2])
    )


def brute_force(rows, tracked=("a", "b")):
    """Versions by a plain walk over each key's rows."""
    out = []
    for key in {r[0] for r in rows}:
        by_seq = {}
        for k, n, i, a, b, op in rows:
            if k == key and (n not in by_seq or i > by_seq[n][0]):
                by_seq[n] = (i, {"a": a, "b": b}, op == "D")
        last = None
        for n in sorted(by_seq):
            _, values, gone = by_seq[n]
            state = (gone, *(values[c] for c in tracked))
            if last and last["state"] == state:
                last["values"] = values
                continue
            if last:
                last["end"] = at(n)
            last = {"key": key, "state": state, "values": values, "start": at(n), "end": None, "gone": gone}
            out.append(last)
    return sorted(
        ((v["key"], v["values"]["a"], v["values"]["b"], v["start"], v["end"]) for v in out if not v["gone"]),
        key=lambda v: (v[0], v[-2]),
    )


def test_insert_update_delete_reinsert(spark):
    df = frame(spark, [
        ("x", 1, 1, "p", "q", "I"),
        ("x", 3, 2, "r", "q", "U"),
        ("x", 5, 3, "r", "q", "D"),
        ("x", 7, 4, "r", "q", "I"),
        ("y", 2, 5, "s", None, "I"),
    ])
    got = versions(scd2(df, ["k"], "seq", ["id"], **ARGS), "a", "b")
    assert got == [
        ("x", "p", "q", at(1), at(3)),
        ("x", "r", "q", at(3), at(5)),
        ("x", "r", "q", at(7), None),
        ("y", "s", None, at(2), None),
    ]


def test_repeat_and_arrival_order_change_nothing(spark):
    rows = [("x", n, n, "pq"[n % 3 == 0], "z", "I") for n in range(8)]
    shuffled = rows + rows
    random.Random(3).shuffle(shuffled)
    want = versions(scd2(frame(spark, rows), ["k"], "seq", ["id"], **ARGS), "a", "b")
    assert versions(scd2(frame(spark, shuffled), ["k"], "seq", ["id"], **ARGS), "a", "b") == want


def test_null_against_value_is_a_change(spark):
    df = frame(spark, [("x", 1, 1, None, "q", "I"), ("x", 2, 2, None, "q", "I"), ("x", 3, 3, "p", "q", "I"), ("x", 4, 4, None, "q", "I")])
    assert [v[1] for v in versions(scd2(df, ["k"], "seq", ["id"], **ARGS), "a")] == [None, "p", None]


def test_null_delete_predicate_is_no_delete(spark):
    df = frame(spark, [("x", 1, 1, "p", "q", None)])
    assert len(versions(scd2(df, ["k"], "seq", ["id"], **ARGS), "a")) == 1


def test_tie_breaker_decides_equal_sequence(spark):
    df = frame(spark, [("x", 1, 2, "new", "q", "I"), ("x", 1, 1, "old", "q", "I")])
    assert versions(scd2(df, ["k"], "seq", ["id"], **ARGS), "a") == [("x", "new", at(1), None)]


def test_untracked_column_is_updated_in_place(spark):
    df = frame(spark, [("x", 1, 1, "p", "one", "I"), ("x", 2, 2, "p", "two", "U"), ("x", 3, 3, "r", "three", "U")])
    got = versions(scd2(df, ["k"], "seq", ["id"], tracked=["a"], **ARGS), "a", "b")
    assert got == [("x", "p", "two", at(1), at(3)), ("x", "r", "three", at(3), None)]


def test_tracked_sequence_makes_every_change_a_version(spark):
    df = frame(spark, [("x", 1, 1, "p", "q", "I"), ("x", 2, 2, "p", "q", "U"), ("x", 2, 2, "p", "q", "U")])
    got = versions(scd2(df, ["k"], "seq", ["id"], tracked=["a", "seq"], **ARGS), "a")
    assert got == [("x", "p", at(1), at(2)), ("x", "p", at(2), None)]


def test_current_and_as_of(spark):
    df = frame(spark, [("x", 1, 1, "p", "q", "I"), ("x", 3, 2, "r", "q", "U"), ("y", 4, 3, "s", "q", "I")])
    h = scd2(df, ["k"], "seq", ["id"], **ARGS)
    assert sorted(r.a for r in current(h).collect()) == ["r", "s"]
    assert [r.a for r in as_of(h, str(at(1))).collect()] == ["p"]
    assert [r.a for r in as_of(h, str(at(3))).collect()] == ["r"]
    assert as_of(h, str(at(0))).count() == 0


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError, match="nope"):
        scd2(frame(spark, []), ["k"], "nope")


ROWS = st.lists(
    st.tuples(
        st.sampled_from("xyz"), st.integers(0, 40), st.integers(0, 10**6),
        st.sampled_from(["p", "q", None]), st.sampled_from(["u", None]), st.sampled_from("IIID"),
    ),
    min_size=1, max_size=60, unique_by=(lambda r: r[2],),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, floor=st.sampled_from([1, 5, 10**6]), tracked=st.sampled_from([None, ("a",)]))
def test_any_feed_equals_brute_force(spark, rows, floor, tracked):
    got = scd2(frame(spark, rows), ["k"], "seq", ["id"], tracked=tracked, split_floor=floor, **ARGS)
    assert versions(got, "a", "b") == brute_force(rows, tracked or ("a", "b"))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_scd1_is_the_open_versions(spark, rows):
    df = frame(spark, rows)
    newest = {(r.k, r.a, r.b) for r in scd1(df, ["k"], "seq", ["id"], **ARGS).collect()}
    opened = {(r.k, r.a, r.b) for r in current(scd2(df, ["k"], "seq", ["id"], **ARGS)).collect()}
    assert newest == opened


def test_a_split_key_gives_the_same_history(spark):
    rng = random.Random(5)
    rows = [
        ("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", rng.randrange(3000), i, rng.choice("pq"), rng.choice("uv"), rng.choice("IIIID"))
        for i in range(6000)
    ]
    rows += [("hot", 77, 10_000 + i, "p", "u", "I") for i in range(1500)]
    df = frame(spark, rows)
    for tracked in (None, ("a",)):
        whole = scd2(df, ["k"], "seq", ["id"], tracked=tracked, **ARGS)
        split = scd2(df, ["k"], "seq", ["id"], tracked=tracked, split_floor=500, **ARGS)
        assert "_segment" in split._jdf.queryExecution().optimizedPlan().toString()
        assert versions(split, "a", "b") == versions(whole, "a", "b") == brute_force(rows, tracked or ("a", "b"))


def test_intervals_of_a_key_do_not_overlap(spark):
    rng = random.Random(9)
    rows = [(f"k{rng.randrange(5)}", rng.randrange(200), i, rng.choice("pq"), "u", rng.choice("IID")) for i in range(400)]
    last = {}
    for k, _, start, end in versions(scd2(frame(spark, rows), ["k"], "seq", ["id"], **ARGS), "a"):
        assert end is None or start < end
        assert k not in last or (last[k] is not None and last[k] <= start)
        last[k] = end


def test_deletes_can_stay_as_flagged_rows(spark):
    df = frame(spark, [("x", 1, 1, "p", "q", "I"), ("x", 2, 2, "p", "q", "D")])
    kept = scd2(df, ["k"], "seq", ["id"], keep_deletes=True, **ARGS)
    assert {r[history.DELETED] for r in kept.collect()} == {True, False}
    assert scd1(df, ["k"], "seq", ["id"], keep_deletes=True, **ARGS).first()[history.DELETED] is True
