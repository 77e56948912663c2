"""Exact token counts at every word prefix of a text, from one count per distinct word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table

# The counts of so many distinct words are kept per Python worker; longer words are never kept.
KEPT_WORDS, KEPT_LENGTH = 400_000, 64


class PrefixCounter:
    """``prefix(text)[i]`` is the number of tokens of the first ``i`` words.

    The tokenizer drops ASCII white space and never merges across it, so the count of a prefix
    that ends between words is the sum over its words: P[i+1] = P[i] + tokens(word i).  With P at
    hand, the tokens of any run of words are a difference and the longest prefix within a budget is
    a binary search; nothing is encoded again."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def counts(self, words: set[bytes]) -> dict[bytes, int]:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known, new = {}, list(words)
        encoded = self.tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)
        counts = dict(zip(new, map(len, encoded), strict=True))
        self.known.update((w, n) for w, n in counts.items() if len(w) <= KEPT_LENGTH)
        return self.known | counts if any(len(w) > KEPT_LENGTH for w in new) else self.known

    def prefixes(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [t.encode().split() for t in texts]  # on ASCII white space
        counts = self.counts(set().union(*split))
        for words in split:
            prefix = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.fromiter(map(counts.__getitem__, words), np.int64, len(words)), out=prefix[1:])
            yield prefix


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def _pieces(batches: Iterator[pd.DataFrame], most_chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Batches cut by their size in characters, so that memory is bounded whatever the texts."""
    for batch in batches:
        sizes = batch["_text"].str.len().cumsum() // most_chars
        for _, piece in batch.groupby(sizes, sort=False):
            yield piece


def prefix_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``prefix``, the array P of tokens in the first 0, 1, ... words.

    A null or empty text gives ``[0]``.  Repeated rows are answered each; further columns are left
    out.  ``tokenizer`` is the path of a vocabulary that every executor can read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            yield pd.DataFrame({"_id": piece["_id"].astype("Int64"), "prefix": list(counter(tokenizer).prefixes(list(piece["_text"])))})

    return _slim(df, id_col, text_col).mapInPandas(run, "_id long, prefix array<long>").withColumnRenamed("_id", id_col)


def tokens_between(prefix, first, last):
    """Tokens of the words ``first`` (from 0) up to ``last`` (exclusive)."""
    return F.element_at(prefix, last + 1) - F.element_at(prefix, first + 1)


def words_within(prefix, budget):
    """The most words whose tokens fit into ``budget``."""
    return F.size(F.filter(prefix, lambda n: n <= budget)) - 1


def budgets(df: DataFrame, tokenizer: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_bytes``, ``n_tokens`` and ``fit_words`` (words of the longest prefix within
    ``budget``), answered from P inside the task, without sending P on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            totals, fits = [], []
            for prefix in counter(tokenizer).prefixes(list(piece["_text"])):
                totals.append(int(prefix[-1]))
                fits.append(int(np.searchsorted(prefix, budget, side="right")) - 1)
            yield pd.DataFrame({"_id": piece["_id"].astype("Int64"), "n_bytes": piece["_bytes"], "n_tokens": totals, "fit_words": fits})

    slim = _slim(df, id_col, text_col).withColumn("_bytes", F.octet_length("_text").cast("long"))
    return slim.mapInPandas(run, "_id long, n_bytes long, n_tokens long, fit_words long").withColumnRenamed("_id", id_col)


LIMIT = 2048


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public word vocabulary."""
    import public_tokenizers

    found = budgets(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), LIMIT)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_words")
