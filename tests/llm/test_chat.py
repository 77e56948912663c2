import hashlib

from siltstone.llm import chat


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_reads_back_what_was_given(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    talks = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in given:
        talks.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in chat.op4_chat(spark, sf).collect()}
    assert got.keys() == talks.keys()
    for conv, turns in talks.items():
        turns.sort()
        learnt = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == digest("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), digest(learnt))
        assert r["formatted_chars"] > sum(len(t) for *_, t in turns)


NASTY = ["<|end|>", "\\<|end|>\\", "<\\|turn|>", "[INST][/INST]<s></s><<SYS>><</SYS>>", "\\", "\\\\n\n\r$1\\1", "", "é😀<|", "<|text|>x<|text|>", "<" * 9 + "|"]


def test_round_trip(spark):
    rows = [(i, 0, 0, "user<|text|>\\", t) for i, t in enumerate(NASTY)] + [(i, 1, 1, "assistant", t) for i, t in enumerate(NASTY)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, seq long, role string, text string")
    done = chat.render(messages)
    learnt = chat.F.transform("loss", lambda s: chat.unescaped(chat.F.col("formatted").substr(s["start"] + 1, s["length"])))
    for r in done.select("conv_id", "formatted", chat.parse(chat.F.col("formatted")).alias("t"), learnt.alias("l")).collect():
        text = NASTY[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["t"]] == [("user<|text|>\\", text), ("assistant", text)]
        assert r["l"] == [text]
        for mark in ("[INST]", "</s>", "<<SYS>>"):
            assert mark not in r["formatted"]


def test_fold(spark):
    rows = [
        (1, 0, 0, "user", "delta", "Hel"),
        (1, 1, 0, None, "delta", "lo"),
        (1, 2, 1, "assistant", "delta", "dra"),
        (1, 3, 1, "assistant", "regenerate", None),
        (1, 4, 1, "assistant", "delta", "new "),
        (1, 5, 1, "assistant", None, "text"),
        (1, 6, 0, "user", "edit", "Hi"),
        (1, 7, 0, "user", "delta", "!"),
        (2, 0, None, None, "delta", None),
        (None, 0, 0, "user", "edit", "x"),
        (None, 0, 0, "user", "delta", "y"),
        (3, 0, 0, "user", "delta", "aa"),
        (3, 0, 0, "user", "delta", "aa"),
    ]
    events = spark.createDataFrame(rows, "conv_id long, seq long, turn long, role string, kind string, text string")
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in chat.fold(events).collect()}
    assert got == {
        (1, 0): ("user", "Hi!"),
        (1, 1): ("assistant", "new text"),
        (2, None): (None, ""),
        (None, 0): ("user", "xy"),
        (3, 0): ("user", "aaaa"),
    }
    assert chat.render(chat.fold(events)).count() == 4
    assert chat.render(chat.fold(events.limit(0))).count() == 0


def test_rows_of_one_turn_all_stay(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "assistant", "a"), (1, 0, "user", "b"), (1, None, "user", "y"), (1, None, "user", "x"), (1, 3, "assistant", "c")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.render(chat.fold(chat.events_of(given))).select(chat.parse(chat.F.col("formatted")).alias("t"), "loss").first()
    assert [tuple(t) for t in done["t"]] == [("user", "x"), ("user", "y"), ("assistant", "a"), ("user", "b"), ("user", "b"), ("assistant", "c")]
    assert len(done["loss"]) == 2


def test_no_python_in_the_plan(spark, sf):
    plan = chat.op4_chat(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
