"""Chat formatting: event logs folded into messages, rendered with a template, read back.

Everything is Spark's own expressions; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import table

# A turn is OPEN role TEXT text CLOSE.  Fixed values: marks that templates in use give meaning to.
OPEN, TEXT, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = r"(<)(?=\||/?s>|</?SYS>>)|(\[)(?=/?INST\])"


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put after the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Messages ``conv_id, turn, role, text, seq`` from an event log ``conv_id, seq, turn, role, kind, text``.

    Kinds: ``delta`` adds its text, ``edit`` replaces the text so far, ``regenerate`` clears it
    (its own text, if any, begins the new one); a null or other kind counts as a delta.  In a
    message, only events since its last edit or regeneration are gathered.  A null text is empty;
    the role is that of the last event that has one.  Events with equal ``seq`` go by kind (resets
    first), then text; an event that repeats in all columns counts each time.  Events without a
    turn form one message, ordered first; the same holds for conversations without an id.  If there is
    a column ``part``, events of one turn with different parts are different messages.

    Events of one message meet in one task, never those of a whole conversation.  What an edit or
    regeneration replaces is dropped before texts are gathered."""
    keys = ["conv_id", "turn", *[c for c in ("part",) if c in events.columns]]
    reset = F.coalesce(F.col("kind").isin("edit", "regenerate"), F.lit(False))
    rows = events.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *keys[2:],
        F.struct(F.col("seq").cast("long").alias("seq"), (~reset).alias("later"), F.coalesce("text", F.lit("")).alias("text")).alias("_e"),
        F.col("role"),
        reset.alias("_reset"),
    )
    last = rows.where("_reset").groupBy(*keys).agg(F.max("_e").alias("_last"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    live = rows.alias("l").join(last.alias("r"), reduce(Column.__and__, same), "left")
    live = live.select(*[f"l.{k}" for k in keys], "_e", "role", ((F.col("_last").isNull()) | (F.col("_e") >= F.col("_last"))).alias("_live"))
    parts = F.array_sort(F.collect_list(F.when(F.col("_live"), F.col("_e"))))
    return live.groupBy(*keys).agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("_e", "role"))).alias("role"),
        F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"),
        F.min("_e.seq").alias("seq"),
    )


def _wrapped(message: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(F.coalesce(message["role"], F.lit(""))), F.lit(TEXT), escaped(message["text"]), F.lit(CLOSE))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss``.

    Messages stand by turn (null first), then ``seq``, role and text, so ties have one order.  ``loss`` is an
    array of (start, length) in code points over ``formatted``: the escaped text of each turn of
    role ``learn``.  A null text is empty, a null role reads back as an empty one."""
    text = F.coalesce("text", F.lit(""))
    turn = F.struct("turn", "seq", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    rows = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_m"))
    rows = rows.select("conv_id", F.transform("_m", _wrapped).alias("_parts"), F.transform("_m", lambda m: m["role"]).alias("_roles"))
    rows = rows.select("conv_id", F.array_join("_parts", "").alias("formatted"), "_roles", F.transform("_parts", lambda p: F.length(p)).alias("_len"))

    def step(acc: Column, x: Column) -> Column:
        head = F.length(escaped(x["role"])) + len(OPEN) + len(TEXT)
        span = F.array(F.struct((acc["at"] + head).alias("start"), (x["len"] - head - len(CLOSE)).alias("length")))
        spans = F.when(x["role"] == learn, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + x["len"]).alias("at"), spans.alias("spans"))

    pairs = F.zip_with("_roles", "_len", lambda r, n: F.struct(r.alias("role"), n.alias("len")))
    zero = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,length:int>>)").alias("spans"))
    return rows.select("conv_id", "formatted", F.aggregate(pairs, zero, step, lambda a: a["spans"]).alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of (role, text)."""
    turns = F.split(formatted, r"<\|end\|>", -1)
    return F.transform(
        F.slice(turns, F.lit(1), F.size(turns) - 1),
        lambda t: F.struct(
            unescaped(F.substring_index(F.substring(t, len(OPEN) + 1, 2**31 - 1), TEXT, 1)).alias("role"),
            unescaped(F.substring_index(t, TEXT, -1)).alias("text"),
        ),
    )


def events_of(conversations: DataFrame) -> DataFrame:
    """Finished conversations as a log of one delta per row.

    Rows of one turn, or without one, are parts of it by role and text, so every row remains a message."""
    part = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return conversations.select("conv_id", F.col("turn").alias("seq"), "turn", part.alias("part"), "role", F.lit("delta").alias("kind"), "text")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of all formatted conversations, read back from the formatted text."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text")
    )
    done = render(fold(events_of(given.unionByName(planted))))
    done = done.withColumn("_turns", parse(F.col("formatted")))
    learnt = F.array_join(F.transform("loss", lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["length"]))), "")
    return done.withColumn("_learnt", learnt).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("_learnt").cast("long").alias("loss_chars"),
        F.sha2("_learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
