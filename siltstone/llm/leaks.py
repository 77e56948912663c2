"""Benchmark decontamination: rare word n-grams seed, Smith-Waterman alignment decides.

Test items are few next to the corpus, so they travel to the documents, in parts of bounded size; no
document is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import key_columns, keyed, stored, table

SEED = 3  # words in a seed
RARE = 1e-8  # a seed is rare if the product of its words' shares of the corpus is at most this
MIN_WORDS = 5  # shorter items can't be told from chance
MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5  # share of an item's own best score that an alignment must reach
PART_CHARS = 4_000_000  # characters of items that are searched for in one pass

_WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two sequences of word numbers: score, first and end word in the text.

    One vector step per word of the item.  A cell holds its score and, in the low bits, where its
    alignment began (earlier wins ties); gaps along the text are a running maximum."""
    n = len(text)
    begin = (1 << 31) - 1 - np.arange(n + 1, dtype=np.int64)
    slope = -GAP * (np.arange(n + 1, dtype=np.int64) << 32)
    row, best, end = begin.copy(), 0, 0
    for word in item:
        new = np.maximum(row + (GAP << 32), begin)
        step = np.where(text == word, MATCH, MISMATCH).astype(np.int64) << 32
        np.maximum(new[1:], row[:-1] + step, out=new[1:])
        row = np.maximum(np.maximum.accumulate(new + slope) - slope, begin)
        top = int(row.argmax())
        if row[top] >> 32 > best >> 32:
            best, end = int(row[top]), top
    return best >> 32, (1 << 31) - 1 - (best & ((1 << 32) - 1)) if best else 0, end


@dataclass
class Items:
    """Test items as word numbers (from 1), and their seeds sorted by key, each with its items and places."""

    ids: list
    texts: list[np.ndarray]
    numbers: dict[str, int]
    keys: np.ndarray
    at: np.ndarray
    item: np.ndarray
    place: np.ndarray


def _keys(numbers: np.ndarray, base: int) -> np.ndarray:
    """A number for every run of SEED words; words outside the vocabulary make it invalid (-1)."""
    size = len(numbers) - SEED + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    key, known = np.zeros(size, np.int64), np.ones(size, bool)
    for k in range(SEED):
        part = numbers[k : k + size]
        key = key * base + part
        known &= part > 0
    return np.where(known, key, -1)


def index(items: list[tuple], shares: dict[str, float]) -> Items:
    """Seeds of the items.  An item without a rare seed keeps them all."""
    lists = [(i, w) for i, t in items if len(w := words_of(t or "")) >= MIN_WORDS]
    numbers = {w: k for k, w in enumerate(sorted({w for _, ws in lists for w in ws}), 1)}
    base = len(numbers) + 1
    share = np.array([1.0] + [shares.get(w, 0.0) for w in numbers])
    texts = [np.array([numbers[w] for w in ws], np.int64) for _, ws in lists]
    keys, own, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, text in enumerate(texts):
        seeds = _keys(text, base)
        rarity = np.prod([share[text[j : j + len(seeds)]] for j in range(SEED)], axis=0)
        chosen = np.flatnonzero(rarity <= RARE)
        if not len(chosen):
            chosen = np.arange(len(seeds))
        keys.append(seeds[chosen])
        own.append(np.full(len(chosen), k))
        place.append(chosen)
    keys, own, place = np.concatenate(keys), np.concatenate(own), np.concatenate(place)
    order = np.lexsort((place, own, keys))
    unique, at = np.unique(keys[order], return_index=True)
    return Items([i for i, _ in lists], texts, numbers, unique, np.append(at, len(order)), own[order], place[order])


def search(items: Items, text: str) -> list[tuple]:
    """``(item, score, first word, end word)`` of each item's best alignment that reaches SCORE."""
    numbers = np.fromiter((items.numbers.get(w, 0) for w in words_of(text)), np.int64)
    keys = _keys(numbers, len(items.numbers) + 1)
    if not len(keys) or not len(items.keys):
        return []
    near = np.searchsorted(items.keys, keys)
    near[near == len(items.keys)] = 0
    hits = np.flatnonzero(items.keys[near] == keys)
    places: dict[int, list[tuple[int, int]]] = {}
    for p in hits:
        for s in range(items.at[near[p]], items.at[near[p] + 1]):
            k = int(items.item[s])
            size = len(items.texts[k])
            slack = size // 4 + 4
            start = int(p) - int(items.place[s])
            spans = places.setdefault(k, [])
            a, b = max(0, start - slack), min(len(numbers), start + size + slack)
            if spans and a <= spans[-1][1]:
                spans[-1] = (min(spans[-1][0], a), max(spans[-1][1], b))
            else:
                spans.append((a, b))
    found = []
    for k, spans in sorted(places.items()):
        best = (0, 0, 0)
        for a, b in spans:
            score, first, end = align(items.texts[k], numbers[a:b])
            if score > best[0]:
                best = (score, a + first, a + end)
        share = best[0] / (MATCH * len(items.texts[k]))
        if share >= SCORE:
            found.append((k, share, best[1], best[2]))
    return found


def _shares(docs: DataFrame, items: list[tuple]) -> dict[str, float]:
    """The items' words with their share of all words of the corpus; one row per word comes back."""
    vocabulary = frozenset(w for _, t in items for w in words_of(t or ""))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = Counter(), 0
        for batch in batches:
            for text in batch["_text"]:
                words = words_of(text)
                total += len(words)
                seen.update(filter(sent.value.__contains__, words))
        yield pd.DataFrame({"word": [*seen, None], "n": [*seen.values(), total]})

    rows = docs.select("_text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    total = max(1, sum(r["n"] for r in rows if r["word"] is None))
    return {r["word"]: r["n"] / total for r in rows if r["word"] is not None}


def _parts(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Distinct items with words, in parts of about PART_CHARS characters, the same parts each time."""
    own = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL").distinct()
    parts = -(-(own.agg(F.sum(F.length("t"))).first()[0] or 0) // PART_CHARS)
    for p in range(parts):
        rows = own.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).collect()
        yield sorted(((r["i"], r["t"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _hits(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``_id, _k1, _k2, item_id, score, first_word, end_word`` for keyed documents."""
    found = None
    schema = "_id long, _k1 long, _k2 long, item_id long, score double, first_word int, end_word int"
    names = [f.split()[0] for f in schema.split(", ")]
    for part in _parts(benchmark, item_col, text_col):
        sent = docs.sparkSession.sparkContext.broadcast(index(part, _shares(docs, part)))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [
                    (i, k1, k2, sent.value.ids[k], score, first, end)
                    for i, k1, k2, text in zip(batch["_id"], batch["_k1"], batch["_k2"], batch["_text"], strict=True)
                    for k, score, first, end in search(sent.value, text)
                ]
                out = pd.DataFrame(rows, columns=names)
                yield out.assign(_id=out["_id"].astype("Int64"), item_id=out["item_id"].astype("Int64"))

        hits = docs.select("_id", "_k1", "_k2", "_text").mapInPandas(run, schema)
        found = hits if found is None else found.unionByName(hits)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that it holds: ids, ``score`` (share of the item's best possible
    score), ``first_word`` and ``end_word`` of the aligned passage, counted in the document.

    Null and empty texts hold nothing; items that are null or shorter than MIN_WORDS words are found nowhere;
    items that repeat an id and text count once, rows that repeat a document are answered each; of
    equal alignments the first counts; further columns are left out; an empty table on
    either side gives an empty result.  The corpus is read twice for each part of the items and never shuffled."""
    found = _hits(keyed(df, id_col, text_col), benchmark, item_col, item_text_col)
    return found.select(F.col("_id").alias(id_col), F.col("item_id").alias(item_col), "score", "first_word", "end_word")


# Keys of two numbers: some 25 MB.
KEYS_BROADCAST = 500_000


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all their columns, that hold no item."""
    hits = _hits(keyed(df, id_col, text_col), benchmark, item_col, item_text_col)
    hits = stored(hits.select("_k1", "_k2").distinct(), "leaks").toDF("_key_one", "_key_two")
    hits = F.broadcast(hits) if hits.count() <= KEYS_BROADCAST else hits
    own = key_columns(df, id_col, text_col)
    return df.join(hits, (own[0] == hits["_key_one"]) & (own[1] == hits["_key_two"]), "left_anti")


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
