"""Mixing sources to target weights: blocks of words, counts per shard, index permutations, a join.

Everything is Spark's own expressions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import WORD, stored, table

WEIGHTS = (5, 2, 1)  # fixed values: repeated over the sources in order
MOST = 3  # no source (and so no document) is taken more often
BLOCK, FINEST = 64, 64  # words in a block; a small source is cut into up to FINEST blocks
BUCKET_ROWS = 2_000  # documents per prefix-sum task
COPIES = 256  # equal rows that travel as one
SHARD_SLOTS = 16_384  # slots that are made from one row
SHARD_BLOCKS = 16_384  # blocks in an output shard
SOURCES_BROADCAST = 100_000  # sources with their numbers, some 10 MB
# Primes above 2^33 that multiply block indexes, one per pass over a source.
PRIMES = (8589934609, 10737418247, 12884901893)


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return df.select(F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("_source"), size.alias("_size"), F.xxhash64(F.col(text_col)).alias("_h"))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: ``_source, _total, _target, _blocks, _slots, _buckets``.

    Sources in code point order, null last, weigh 5, 2, 1, 5, ...; a target stops at three times its
    source's size and the excess is shared again by weight.  That is one level L with targets
    min(3 size, weight L): sources are put by 3 size / weight, and L is the first level at which the sources
    before it are full.  This runs on one row per source."""
    sums = rows.groupBy("_source").agg(F.sum("_size").alias("_total"), F.count("*").alias("_rows"))
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    sums = sums.withColumn("_weight", weight).withColumn("_cap", MOST * F.col("_total") / F.col("_weight"))
    order = Window.orderBy("_cap", F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("_total").over(whole) - F.coalesce(F.sum(F.col("_total") * MOST).over(before), F.lit(0))) / F.sum("_weight").over(onward)
    sums = sums.withColumn("_level", level)
    reached = F.min(F.when(F.col("_level") <= F.col("_cap"), F.struct("_cap", "_level"))).over(whole)["_level"]
    sums = sums.withColumn("_target", F.least(F.col("_total") * F.lit(float(MOST)), F.coalesce(F.col("_weight") * reached, F.lit(0.0))))
    blocks = F.greatest(F.ceil(F.col("_total") / BLOCK), F.least(F.col("_total"), F.lit(FINEST))).cast("long")
    sums = sums.withColumn("_blocks", blocks)
    slots = F.least(F.round(F.try_divide(F.col("_target") * F.col("_blocks"), F.col("_total"))).cast("long"), MOST * F.col("_blocks"))
    return sums.select("_source", "_total", "_target", "_blocks", F.coalesce(slots, F.lit(0)).alias("_slots"), F.ceil(F.col("_rows") / BUCKET_ROWS).cast("long").alias("_buckets"))


def _mod(k: Column, prime: Column, shift: Column, n: Column) -> Column:
    """(k * prime + shift) mod n, beyond 64 bits: a permutation of 0..n-1, since the prime is
    larger than n's factors or, where it divides n, is left out by the caller."""
    wide = k.cast("decimal(19,0)") * prime.cast("decimal(11,0)") + shift.cast("decimal(19,0)")
    return (wide % n.cast("decimal(19,0)")).cast("long")


def draws(plan: DataFrame, seed: int = 0) -> DataFrame:
    """``_source, _shard, _slot, _block``: which block of its source fills each slot.

    Each slot of a source goes to an output shard by a seeded hash.  So the counts of a source over the shards are a
    multinomial draw, while their sum is the source's number of slots: totals meet the targets and reruns
    agree.  Slot k of a source takes block perm(k mod blocks), with another permutation for each pass over the source."""
    live = plan.where("_slots > 0")
    everything = F.sum("_slots").over(Window.partitionBy())
    live = live.withColumn("_shards", F.greatest(F.ceil(everything / SHARD_BLOCKS), F.lit(1)).cast("long"))
    # Deal runs of slots out before the slots are made: a hot source's slots come from many rows.  With a number of its
    # own the exchange stays as wide as the session's, however few bytes the runs have.
    runs = live.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1, F.lit(SHARD_SLOTS).cast("long"))))
    width = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(width, F.col("_source"), F.col("_from"))
    slots = runs.withColumn("_slot", F.explode(F.sequence("_from", F.least(F.col("_from") + SHARD_SLOTS, F.col("_slots")) - 1)))
    slots = slots.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "_source", "_slot"), F.col("_shards")))
    turn = F.floor(F.col("_slot") / F.col("_blocks")).cast("int")
    prime = F.element_at(F.array(*map(F.lit, PRIMES)), turn + 1)
    prime = F.when(F.col("_blocks") % prime == 0, F.lit(1)).otherwise(prime)
    shift = F.pmod(F.xxhash64(F.lit(seed), "_source", turn), F.col("_blocks"))
    return slots.select("_source", "_shard", "_slot", _mod(F.col("_slot") % F.col("_blocks"), prime, shift, F.col("_blocks")).alias("_block"))


def offsets(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document with the place ``_at`` of its first word in its source.

    Rows that are equal are counted first and travel as one row for each ``COPIES`` of them.  Prefix sums go in two
    levels: rows are dealt into buckets of bounded size, sums of buckets are added up per source, then each
    bucket on its own.  A hot source is many buckets, and so is a document that repeats very often."""
    plan = plan.select(F.col("_source").alias("_s"), "_total", "_target", "_blocks", "_buckets")
    rows = rows.groupBy("_source", "_id", "_h", "_size").agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
    rows = rows.withColumn("_n", F.least(F.col("_n") - F.col("_copy"), F.lit(COPIES)))
    rows = rows.join(F.broadcast(plan) if plan.count() <= SOURCES_BROADCAST else plan, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_h", "_copy"), F.col("_buckets")))
    words = F.col("_size") * F.col("_n")
    sums = rows.groupBy("_source", "_bucket").agg(F.sum(words).alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_id", "_h", "_size", "_copy").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inner", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    rows = rows.join(sums.hint("merge"), same).withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    rows = rows.withColumn("_at", F.col("_base") + F.col("_inner") + F.col("_turn") * F.col("_size"))
    return rows.drop("_s", "_b", "_base", "_inner", "_bucket", "_buckets", "_n", "_copy", "_turn")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """One row per row of ``df``: id, ``size`` (words), ``source_size``, ``target``, ``taken``.

    Each source's words stand in a row and are cut into equal blocks; the mix takes blocks, so a
    document's words are taken as often as the blocks over them.  No word is taken more than three times.
    Null or empty texts have size 0 and nothing taken; very long texts are cut into blocks like others; a null source is a source of its own, last in
    order; repeated rows are separate stretches; further columns are left out; empty gives empty."""
    return _taken(df, id_col, text_col, source_col, seed)[0]


def _taken(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> tuple[DataFrame, DataFrame]:
    rows = stored(sized(df, id_col, text_col, source_col), "sizes")
    plan = stored(targets(rows), "targets")
    drawn = draws(plan, seed)
    times = drawn.groupBy("_source", "_block").agg(F.count("*").alias("_times"))
    placed = offsets(rows, plan).withColumn("_row", F.monotonically_increasing_id())
    placed = stored(placed, "places")
    pieces = _pieces(placed)
    same = F.col("p._source").eqNullSafe(F.col("t._source")) & (F.col("p._block") == F.col("t._block"))
    taken = pieces.alias("p").join(times.alias("t").hint("merge"), same).groupBy("_row").agg(F.sum(F.col("_words") * F.col("_times")).alias("_taken"))
    out = placed.join(taken.hint("merge"), "_row", "left").select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
    )
    return out, drawn


def _start(block: Column) -> Column:
    """First word of a block: blocks of a source are of one length, give or take a word."""
    return F.floor(block.cast("decimal(19,0)") * F.col("_total") / F.col("_blocks").cast("decimal(19,0)")).cast("long")


def _pieces(placed: DataFrame) -> DataFrame:
    """``_row, _source, _block, _words``, plus ``_skip`` words of the document before the piece."""
    full = placed.where("_size > 0")
    guess = lambda at: F.floor(at * F.col("_blocks") / F.col("_total")).cast("long")
    low = F.greatest(guess(F.col("_at")) - 1, F.lit(0))
    high = F.least(guess(F.col("_at") + F.col("_size")) + 1, F.col("_blocks") - 1)
    cut = full.withColumn("_block", F.explode(F.sequence(low, high)))
    first = F.greatest(_start(F.col("_block")), F.col("_at"))
    last = F.least(_start(F.col("_block") + 1), F.col("_at") + F.col("_size"))
    cut = cut.withColumn("_skip", first - F.col("_at")).withColumn("_words", last - first)
    return cut.where("_words > 0").select("_row", "_id", "_h", "_source", "_block", "_skip", "_words")


def mixed_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: ``shard, slot, source, block, words``, one row per slot, the words of its
    block joined by blanks.  Same treatment of nulls and repeated rows as ``mix``."""
    rows = stored(sized(df, id_col, text_col, source_col), "sizes")
    plan = stored(targets(rows), "targets")
    pieces = _pieces(stored(offsets(rows, plan).withColumn("_row", F.monotonically_increasing_id()), "places"))
    texts = df.select(F.col(id_col).cast("long").alias("_i"), F.xxhash64(F.col(text_col)).alias("_x"), F.col(text_col).alias("_t")).groupBy("_i", "_x").agg(F.first("_t").alias("_t"))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_x"))
    words = F.slice(F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)), (F.col("_skip") + 1).cast("int"), F.col("_words").cast("int"))
    part = F.struct("_row", F.array_join(words, " ").alias("words"), F.col("_words").alias("n"))
    blocks = pieces.join(texts, same).groupBy("_source", "_block").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    drawn = draws(plan, seed).select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), "_shard", "_slot")
    found = drawn.join(blocks, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    return found.select(
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_source").alias("source"), F.col("_block").alias("block"),
        F.array_join(F.transform("_parts", lambda p: p["words"]), " ").alias("words"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights."""
    return mix(table(spark, sf_dir, "documents"))
