"""Removal of long passages that occur more than once, by minimizer factors.

They stand in for greedy relative Lempel-Ziv parsing: a greedy factor begins where the last match ended, so a
document would have to meet an index of the whole reference from its first word on, one word after the other; factors whose bounds
depend on their own words only are matched by equality, in one shuffle.  No longest match is sought, and none
is needed for what is removed.

A window of ``WINDOW`` words belongs to
exactly one anchor, its least hashed run of ``GRAM`` words (leftmost if equal), so equal windows have equal
anchors, wherever they stand.  The windows of one anchor cover one factor of at most
2 * WINDOW - GRAM words.  Anchors deal the reference into blocks: all factors with one anchor form one.

* A factor found whole in its block is a copy: every window in it occurs elsewhere.
* Where a copied passage begins or ends, factors differ beyond the boundary.  If a block holds several
  different factors, the windows of each different factor are looked up one by one.

Only distinct factors are looked up by window, so copies cost one row each, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import _MUL, keyed, mixed, run_hashes, stored, table, word_hashes

WINDOW, GRAM = 35, 12
_OTHER = np.uint64(0xA0761D6478BD642F)
# Words that are hashed together; a longer document makes a piece of its own.
PIECE_WORDS = 500_000
MORE = 16  # bits for the number of further windows of a factor (below WINDOW)
# Keys of two numbers that are broadcast at most (some 25 MB).
KEYS_BROADCAST = 500_000


def least_positions(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the least of every ``width`` consecutive values, by doubling."""
    place, span = np.arange(len(values)), 1

    def step(shift: int) -> None:
        nonlocal place
        left, right = place[: len(place) - shift], place[shift:]
        place = np.where(values[left] <= values[right], left, right)

    while 2 * span <= width:
        step(span)
        span *= 2
    if span < width:
        step(width - span)
    return place


def _stretches(texts: list[str]) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Consecutive texts cut into groups of about PIECE_WORDS words: first, end, their words."""
    first, words, count = 0, [], 0
    for i, text in enumerate(texts):
        words.append(text.encode().split())
        count += len(words[-1])
        if count >= PIECE_WORDS:
            yield first, i + 1, words
            first, words, count = i + 1, [], 0
    if words:
        yield first, len(texts), words


def parse(words: list[list[bytes]], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Factors of some documents: document, anchor, factor hash, first and last window (counted in
    the document), and the hash of every window by place in the joined words, with documents' offsets."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    hashes = word_hashes([w for doc in words for w in doc])
    empty = np.zeros(0, np.int64)
    if len(hashes) < window:
        return empty, empty, empty, empty, empty, empty, starts
    doc = np.repeat(np.arange(len(words)), sizes)
    grams, windows = run_hashes(hashes, gram), run_hashes(hashes, window)
    anchor = least_positions(grams, window - gram + 1)
    inside = np.flatnonzero(doc[: len(windows)] == doc[window - 1 :])
    if not len(inside):
        return empty, empty, empty, empty, empty, windows.view(np.int64), starts
    own = anchor[inside]
    # A new factor begins where the anchor changes; an anchor lies inside its window, so never
    # belongs to two documents.
    new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.concatenate([new[1:], [len(inside)]]) - 1
    a, b = inside[new], inside[last]
    # First and last window overlap and so fix all words of the factor.
    whole = mixed(mixed(windows[a] * _MUL + windows[b]) + (b - a).astype(np.uint64))
    docs = doc[a]
    return docs, grams[own[new]].view(np.int64), whole.view(np.int64), a - starts[docs], b - starts[docs], windows.view(np.int64), starts


def factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All factors ``_anchor, _factor, _k1, _k2, _at`` of keyed documents; ``_at`` holds the first window
    and, in the low bits, how many more there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2 = batch["_k1"].to_numpy(), batch["_k2"].to_numpy()
            for first, end, words in _stretches(list(batch["_text"])):
                at, anchor, whole, a, b, _, _ = parse(words, window, gram)
                yield pd.DataFrame({"_anchor": anchor, "_factor": whole, "_k1": k1[first:end][at], "_k2": k2[first:end][at], "_at": (a << MORE) + b - a})

    return docs.select("_k1", "_k2", "_text").mapInPandas(run, "_anchor long, _factor long, _k1 long, _k2 long, _at long")


def matched(found: DataFrame) -> DataFrame:
    """Factors of the blocks with several: ``_anchor, _k1, _k2, _at, _copied, _edge``.

    ``_copied``: the same factor stands elsewhere.  ``_edge``: one of each different factor, if its block
    has other ones.  Both follow from the neighbours in sorted order, so no task holds a block."""
    names = ["_anchor", "_factor", "_k1", "_k2", "_at"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait = np.zeros((0, len(names)), np.int64)  # the row whose successor isn't known
        before = (False, False, False)  # its anchor, its factor is that before it; its block had others
        for batch in batches:
            rows = np.vstack([wait, batch.to_numpy(np.int64)])
            if not len(rows):
                continue
            block, same = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
            block[1:] = rows[1:, 0] == rows[:-1, 0]
            same[1:] = block[1:] & (rows[1:, 1] == rows[:-1, 1])
            others = block & ~same
            if len(wait):
                block[0], same[0], others[0] = before
            place = np.arange(len(rows))
            begins = np.maximum.accumulate(np.where(block, 0, place))
            later = np.maximum.accumulate(np.where(others, place, -1)) >= begins
            yield told(rows[:-1], same[:-1], later[:-1], block[1:], same[1:])
            wait, before = rows[-1:], (bool(block[-1]), bool(same[-1]), bool(later[-1]))
        if len(wait):
            no = np.zeros(1, bool)
            yield told(wait, np.array([before[1]]), np.array([before[2]]), no, no)

    def told(rows, same, later, next_block, next_same) -> pd.DataFrame:
        copied, edge = same | next_same, ~next_same & (later | next_block)
        keep = copied | edge
        out = pd.DataFrame(rows[keep], columns=names).drop(columns="_factor")
        return out.assign(_copied=copied[keep], _edge=edge[keep])

    rows = found.repartition("_anchor").sortWithinPartitions("_anchor", "_factor")
    return rows.mapInPandas(run, "_anchor long, _k1 long, _k2 long, _at long, _copied boolean, _edge boolean")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """``_anchor, _window, _copied, _k1, _k2, _a`` for every window of the factors in ``_want`` of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, k1, k2, want in zip(batch["_text"], batch["_k1"], batch["_k2"], batch["_want"], strict=True):
                hashes = run_hashes(word_hashes(text.encode().split()), window).view(np.int64)
                flat = np.array([(w["_a"], w["_b"], w["_anchor"], w["_copied"]) for w in want], np.int64).reshape(-1, 4)
                size = flat[:, 1] - flat[:, 0] + 1
                which = np.repeat(np.arange(len(flat)), size)
                place = flat[which, 0] + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                yield pd.DataFrame({"_anchor": flat[which, 2], "_window": hashes[place], "_copied": flat[which, 3] == 1, "_k1": k1, "_k2": k2, "_a": place.astype(np.int32)})

    return rows.mapInPandas(run, "_anchor long, _window long, _copied boolean, _k1 long, _k2 long, _a int")


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``_k1, _k2, _a, _b``: stretches of windows (first and last) that occur elsewhere too."""
    found = stored(matched(factors(docs, window, gram)), "matched")
    first, last = F.shiftright("_at", MORE), F.shiftright("_at", MORE) + F.col("_at").bitwiseAND((1 << MORE) - 1)
    found = found.withColumn("_a", first.cast("int")).withColumn("_b", last.cast("int"))
    whole = found.where("_copied").select("_k1", "_k2", "_a", "_b")
    # Boundaries of copies: the windows of each different factor of a block.
    edges = found.where("_edge").groupBy("_k1", "_k2").agg(F.collect_list(F.struct("_a", "_b", "_anchor", "_copied")).alias("_want"))
    edges = stored(edges, "edges")
    texts = docs.select("_k1", "_k2", "_text")
    if edges.count() <= KEYS_BROADCAST:
        texts = texts.join(F.broadcast(edges.select("_k1", "_k2")), ["_k1", "_k2"], "left_semi")
    looked = stored(_windows(edges.join(texts, ["_k1", "_k2"]), window), "windows")
    # In two places at least; repeated rows of one document are looked up at the same place.
    place = F.xxhash64("_k1", "_k2", "_a")
    again = looked.groupBy("_anchor", "_window").agg(F.min(place).alias("_p"), F.max(place).alias("_q")).where("_p != _q")
    # Windows of a copied factor are in ``whole`` already.
    single = looked.where("NOT _copied").join(again, ["_anchor", "_window"], "left_semi")
    return whole.unionByName(single.select("_k1", "_k2", "_a", F.col("_a").alias("_b")))


def strip_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``df``: id, ``n_words``, ``n_removed``, ``kept`` (words joined by a blank),
    ``spans`` (stretches of removed words, [first, end) counted in words).

    A word goes if any window of ``window`` words over it occurs anywhere else in the table, the same
    document included.  Null and empty texts, and texts shorter than a window, lose nothing; rows that
    repeat a document are copies of each other and lose all their windows; further columns are left
    out; empty gives empty.  Work grows with the words, not with the number of copies."""
    docs = keyed(df, id_col, text_col)
    gone = repeats(docs, window, gram).groupBy("_k1", "_k2").agg(F.collect_set(F.struct("_a", "_b")).alias("_gone"))
    rows = docs.join(gone, ["_k1", "_k2"], "left").select("_id", "_text", "_gone")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, gone in zip(batch["_text"], batch["_gone"], strict=True):
                words = text.encode().split()
                if gone is None or not len(gone):
                    out.append((len(words), 0, b" ".join(words).decode(), []))
                    continue
                edges = np.zeros(len(words) + 1, np.int64)
                flat = np.array([(g["_a"], g["_b"]) for g in gone], np.int64)
                np.add.at(edges, flat[:, 0], 1)
                np.add.at(edges, flat[:, 1] + window, -1)
                lost = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], lost, [False]]).astype(np.int8)))
                kept = b" ".join([words[i] for i in np.flatnonzero(~lost)]).decode()
                out.append((len(words), int(lost.sum()), kept, [int(t) for t in turns]))
            n, removed, kept, spans = map(list, zip(*out, strict=True)) if out else ([], [], [], [])
            yield pd.DataFrame({"_id": batch["_id"].astype("Int64").to_numpy(), "n_words": n, "n_removed": removed, "kept": kept, "spans": spans})

    out = rows.mapInPandas(run, "_id long, n_words long, n_removed long, kept string, spans array<int>")
    return out.withColumnRenamed("_id", id_col)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 35 or more words that occur again."""
    found = strip_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
