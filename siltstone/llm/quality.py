"""Weak-label quality model: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Two questions are asked of a document, each with its own labellers: is it junk, is it toxic?  A labeller says
1 (yes), 0 (no) or -1 (does not know).  Expectation-maximisation over the counts of vote patterns of
all documents estimates how often each labeller is right, without believing any of them; its posteriors
label a bounded sample, on which a linear model over hashed features is fitted.  That scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import key_columns, keyed, stored, table

# The bound of the sample of labelled rows that the lexicons and the scorer are fitted on.
SAMPLE_ROWS = 4000
# Hash buckets: lexical ones count as present or not, shape ones (the first) by their share of the words.  There
# are so many lexical ones that even a very long text meets none of the model's by chance.
SHAPES, LEXICAL = 1 << 12, 1 << 48
PREFIXES = (4, 5, 6)
KEPT_WORDS = 500_000  # words that each Python worker remembers, in one table (some 60 MB)
# A lexicon entry stands in this share of the documents in question, and this share of the others.
OFTEN, SELDOM = 0.012, 0.0005
# Buckets the linear model uses at most, and how many times more frequent a lexical one must be.
USED, RATIO = 1024, 8
PURE, PURE_ROWS = 0.98, 8

# A document goes when its score reaches the mark; a missed toxic one costs more than a lost fine one.
JUNK_AT, TOXIC_AT = 0.5, 0.25

_WORD = re.compile(r"[^\W\d_]+")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_BEYOND = re.compile(r"[^\x00-\x7f]+")
_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_NO_CAPITALS = bytes(c for c in range(128) if not chr(c).isupper())
_UPPER, _LOWER, _DIGITS = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"\d+")


def _bucket(kind: str, text: str) -> int:
    return SHAPES + xxhash.xxh3_64_intdigest(kind + text) % LEXICAL


def _word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of the word itself and of its prefixes."""
    return (_bucket("w", word), *[_bucket("p", word[:n]) for n in PREFIXES if len(word) >= n])


def lexical(text: str) -> np.ndarray:
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(_word_buckets(word))
    return np.array(sorted(found), np.int64)


def _shape(word: str) -> str:
    """The word with runs of letters and digits as one sign each, at most four signs from its end."""
    if word.isascii() and word.isalpha():
        if word.islower():
            return "a"
        if word.istitle():
            return "Aa" if len(word) > 1 else "A"
    return _DIGITS.sub("0", _LOWER.sub("a", _UPPER.sub("A", word)))[-4:]


def _shape_bucket(word: str) -> int:
    return xxhash.xxh3_64_intdigest(_shape(word)) % (SHAPES - 1) + 1


def repeated(words: list[str]) -> int:
    """How many words are the same as the one before."""
    return sum(map(eq, words, words[1:]))


def shapes(words: list[str], counted: Counter[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of word shapes, and of words that repeat the one before, with their shares."""
    counts: dict[int, int] = {}
    for word, n in counted.items():
        at = _shape_bucket(word)
        counts[at] = counts.get(at, 0) + n
    return _shares(counts, words)


def _shares(counts: dict[int, int], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    if again := repeated(words):
        counts[0] = again
    keys = sorted(counts)
    return np.array(keys, np.int64), np.array([counts[k] / max(1, len(words)) for k in keys], np.float32)


def _says(value: float, yes: float, no: float) -> int:
    return 1 if value >= yes else 0 if value <= no else -1


def _letters(text: str) -> tuple[int, int]:
    """How many letters and how many capitals: ASCII is counted as bytes, the rest by pattern."""
    plain = text.encode("ascii", "ignore")
    rest = "" if len(plain) == len(text) else "".join(_BEYOND.findall(text))
    letters = len(plain.translate(None, _NO_LETTERS)) + sum(map(len, _WORD.findall(rest)))
    return letters, len(plain.translate(None, _NO_CAPITALS)) + sum(map(len, _CAPITALS.findall(rest)))


def junk_votes(text: str, words: list[str]) -> list[int]:
    """Labellers of junk: capitals, shouting, table debris, symbols, repetition, few letters, odd word lengths."""
    n = len(words)
    if not n:
        return [-1] * 7
    letters, capitals = _letters(text)
    signs = len("".join(words))
    length = letters / n
    shouts = sum(w.endswith("!!") for w in words) if "!!" in text else 0
    ends = Counter([w[-1] for w in words])
    symbols = sum(m for c, m in ends.items() if not c.isalnum() and c not in ".,;:!?)\"'|")
    return [
        _says(capitals / max(1, letters), 0.5, 0.2),
        _says(shouts / n, 0.15, 0.02),
        _says(words.count("|") / n, 0.15, 0.02),
        _says(symbols / n, 0.15, 0.05),
        _says(repeated(words) / n, 0.2, 0.08) if n >= 8 else -1,
        _says(1 - letters / max(1, signs), 0.3, 0.1),
        _says(abs(length - 5) - 4, 4, 1),
    ]


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of "yes" for each vote pattern; the last labeller is the given label.

    Labellers overlap and there are several ways to be junk, so the truth is one of several classes: fine, or
    yes in the way that labeller k sees first.  Each class has its own rate of a yes from each labeller, and
    votes are independent given the class; labellers that see the same thing come to share a class.
    How often a class really is a yes is its rate of yes among given labels, from a prior of nine in ten
    (one in fifty for fine), so a labeller that is often wrong loses its say."""
    yes, known = patterns == 1, patterns >= 0
    own = yes[:, :-1]
    classes = own.shape[1] + 1
    first = np.where(own.any(axis=1), own.argmax(axis=1) + 1, 0) if classes > 1 else np.zeros(len(patterns), int)
    post = np.eye(classes)[first]
    start, weight = np.full((classes, patterns.shape[1]), 0.5), np.ones(patterns.shape[1])
    start[0], start[:, -1], start[0, -1], weight[-1] = 0.01, 0.9, 0.02, 2.0
    for _ in range(rounds):
        mass = counts[:, None] * post
        prior = (mass.sum(axis=0) + 0.01) / (counts.sum() + 0.01 * classes)
        rate = np.clip((mass.T @ yes + weight * start) / (mass.T @ known + weight), 1e-4, 1 - 1e-4)
        score = np.log(prior) + yes @ np.log(rate).T + (known & ~yes) @ np.log(1 - rate).T
        post = np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf))
        post /= post.sum(axis=1, keepdims=True)
    return post @ rate[:, -1]


@dataclass
class Rows:
    """Sparse rows: entries of row i are ``keys[at[i]:at[i + 1]]`` with ``values``."""

    at: np.ndarray
    keys: np.ndarray
    values: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def fit(rows: Rows, label: np.ndarray, rounds: int = 30) -> tuple[dict[int, float], float]:
    """Weights by bucket and bias of a logistic model of soft labels.

    Used are the ``USED`` buckets that tell most: those that stand out by over five standard deviations and, if
    lexical, are ``RATIO`` times as frequent on the side of yes.  Newton steps with a small ridge."""
    n = len(label)
    share = float(label.mean()) if n else 0.0
    if not 1e-6 < share < 1 - 1e-6:
        return {}, -10.0 if share < 0.5 else 10.0
    row = rows.row()
    keys, col = np.unique(rows.keys, return_inverse=True)
    size = len(keys)
    total, square = np.bincount(col, rows.values, size), np.bincount(col, rows.values**2, size)
    own = np.bincount(col, rows.values * label[row], size)
    stand_out = (own - share * total) / np.sqrt(share * (1 - share) * square + 1e-12)
    ratio = (own / (n * share) + 1e-4) / ((total - own) / (n * (1 - share)) + 1e-4)
    tells = (np.abs(stand_out) > 5) & ((keys < SHAPES) | ((ratio > RATIO) & (stand_out > 0)))
    used = np.flatnonzero(tells & (np.bincount(col, minlength=size) >= 4))
    used = used[np.argsort(-np.abs(stand_out[used]), kind="stable")]
    # A word and its prefixes often stand in the same rows: one of them will do.
    marks = np.bincount(col, rows.values * np.sqrt(np.arange(2, n + 2))[row], size)[used].round(6)
    used = used[np.sort(np.unique(marks, return_index=True)[1])][:USED]
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    at = place[col]
    scale = np.minimum(1 / np.sqrt(square[used] / n), 20.0) if len(used) else np.zeros(0)
    scale[keys[used] >= SHAPES] = 1.0
    x = np.zeros((n, len(used) + 1), np.float32)
    x[row[at >= 0], at[at >= 0]] = rows.values[at >= 0] * scale[at[at >= 0]]
    x[:, -1] = 1
    w = np.zeros(len(used) + 1)
    w[-1] = np.log(share / (1 - share))
    ridge = np.full(len(w), 0.05)
    ridge[-1] = 1e-3

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - label @ z + (ridge * w**2).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T * np.maximum(p * (1 - p), 1e-3)) @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (p - label) + ridge * w)
        while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step /= 2
        if now - new < 1e-6 * now:
            break
        w, now = w - step, new
    # Words that come together share their weight; one that stands in yes rows only convicts alone.
    pure = (keys[used] >= SHAPES) & (own[used] >= PURE * total[used]) & (total[used] >= PURE_ROWS)
    weight = np.where(pure, np.maximum(w[:-1] * scale, np.log(9) - w[-1]), w[:-1] * scale)
    return dict(zip(keys[used].tolist(), weight.tolist(), strict=True)), float(w[-1])


@dataclass
class Model:
    """The fitted scorer: at most ``USED`` weights for each question, whatever the corpus."""

    junk: dict[int, float]
    junk_bias: float
    toxic: dict[int, float]
    toxic_bias: float

    def __post_init__(self) -> None:
        self.found: dict[str, tuple[int, tuple[int, ...]]] = {}
        self.same: dict[tuple, tuple] = {}

    def _token(self, token: str) -> tuple[int, tuple[int, ...]]:
        """The shape of a token (a run without blanks) and the buckets of the model that its words fall into."""
        words = _WORD.findall(token.lower())
        found = _shape_bucket(token), tuple(k for word in words for k in _word_buckets(word) if k in self.junk or k in self.toxic)
        if len(self.found) < KEPT_WORDS and len(token) <= 64:
            # Most tokens share their entry with many others.
            self.found[token] = found = self.same.setdefault(found, found)
        return found

    def scores(self, text: str) -> tuple[float, float]:
        words = text.split()
        counts: dict[int, int] = {}
        own: set[int] = set()
        for token, n in Counter(words).items():
            at, buckets = self.found.get(token) or self._token(token)
            counts[at] = counts.get(at, 0) + n
            if buckets:
                own.update(buckets)
        keys, shares = _shares(counts, words)
        present = dict(zip(keys.tolist(), shares.tolist(), strict=True)) | dict.fromkeys(own, 1.0)
        out = []
        for weights, bias in ((self.junk, self.junk_bias), (self.toxic, self.toxic_bias)):
            z = bias + sum(weights[k] * v for k, v in sorted(present.items()) if k in weights)
            out.append(float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))))
        return out[0], out[1]


def _slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, rows: int) -> DataFrame:
    """The labelled ids that hash lowest, one row each, with the worst of their labels."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_i"))
    own = own.agg((1 - F.min("quality")).alias("_junk"), F.max("toxic").alias("_toxic"))
    return own.orderBy(F.xxhash64("_i"), "_i").limit(rows)


_VOTES = ",".join(f"j{i}" for i in range(7)).split(",")


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the scorer.  What reaches the driver is the sample's features (at most ``sample_rows`` rows)
    and one row per vote pattern, of which there are at most 3^10."""
    docs = _slim(df, id_col, text_col)
    chosen = F.broadcast(_sample(docs, labels, id_col, sample_rows))  # bounded by sample_rows

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["_text"]:
                words = text.split()
                keys, shares = shapes(words, Counter(words))
                out.append((lexical(text).tobytes(), keys.tobytes(), shares.tobytes(), junk_votes(text, words)))
            lex, keys, shares, votes = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [], [])
            yield pd.DataFrame({"_junk": batch["_junk"].astype("Int64"), "_toxic": batch["_toxic"].astype("Int64"), "lex": lex, "keys": keys, "shares": shares, "votes": votes})

    schema = "_junk long, _toxic long, lex binary, keys binary, shares binary, votes array<int>"
    sample = docs.join(chosen, docs["_id"] == chosen["_i"]).select("_text", "_junk", "_toxic").mapInPandas(features, schema).collect()
    lex = [np.frombuffer(r["lex"], np.int64) for r in sample]
    gold = np.array([[-1 if r[c] is None else r[c] for c in ("_junk", "_toxic")] for r in sample], int).reshape(-1, 2)
    lexicons = _lexicons(lex, gold[:, 1])
    sent = docs.sparkSession.sparkContext.broadcast(Lexicons(lexicons))

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*junk_votes(t, t.split()), *sent.value.votes(t)) for t in batch["_text"]]
            made = pd.DataFrame(rows, columns=[*_VOTES, "t0", "t1"], dtype="int32")
            for c in ("_junk", "_toxic"):
                made[c] = batch[c].fillna(-1).astype("int32").to_numpy()
            yield made.groupby(list(made.columns), as_index=False).size()

    fields = [*_VOTES, "t0", "t1", "_junk", "_toxic"]
    given = docs.join(chosen, docs["_id"] == chosen["_i"], "left").select("_text", "_junk", "_toxic")
    seen = given.mapInPandas(votes, ", ".join(f"{f} int" for f in fields) + ", size long")
    table_ = seen.groupBy(*fields).agg(F.sum("size").alias("size")).collect()
    table_.sort(key=lambda r: tuple(r[f] for f in fields))
    counts = np.array([r["size"] for r in table_], float)
    post = []
    for own in ([*_VOTES, "_junk"], ["t0", "t1", "_toxic"]):
        patterns = np.array([[r[f] for f in own] for r in table_], int).reshape(-1, len(own))
        post.append({tuple(p): x for p, x in zip(patterns.tolist(), em(patterns, counts), strict=True)} if len(table_) else {})
    # Posteriors of the sample.
    junk, toxic = [], []
    for r, l, g in zip(sample, lex, gold.tolist(), strict=True):
        junk.append(post[0][(*r["votes"], g[0])])
        toxic.append(post[1][(*toxic_votes(l, lexicons), g[1])])
    keys = [np.concatenate([l, np.frombuffer(r["keys"], np.int64)]) for r, l in zip(sample, lex, strict=True)]
    values = [np.concatenate([np.ones(len(l), np.float32), np.frombuffer(r["shares"], np.float32)]) for r, l in zip(sample, lex, strict=True)]
    sizes = np.array([len(k) for k in keys], int)
    keys, values = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.float32), *values])
    del sample, lex
    seen, counts = np.unique(keys, return_counts=True)
    often = np.isin(keys, seen[counts >= 4])  # rarer ones are never used
    row = np.repeat(np.arange(len(sizes)), sizes)[often]
    at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]).astype(int)
    rows = Rows(at, keys[often], values[often])
    return Model(*fit(rows, np.array(junk)), *fit(rows, np.array(toxic)))


def _lexicons(lex: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """Two lists of buckets that toxic documents have and others hardly ever, from either half of the sample."""
    out = []
    for half in (0, 1):
        own = [i for i in range(len(lex)) if i % 2 == half]
        rates = []
        for value in (1, 0):
            rows = [lex[i] for i in own if toxic[i] == value]
            keys, counts = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_counts=True)
            rates.append((keys, counts, max(1, len(rows))))
        (keys, counts, n), (others, seen, m) = rates
        at = np.searchsorted(others, keys)
        at[at == len(others)] = 0
        rate = np.where(others[at] == keys, seen[at], 0) / m if len(others) else np.zeros(len(keys))
        out.append(keys[(counts >= 2) & (counts / n >= OFTEN) & (rate <= SELDOM) & (counts / n > 10 * rate)])
    return out


class Lexicons:
    """The same votes as ``toxic_votes`` straight from a text; remembers which words count."""

    def __init__(self, lexicons: list[np.ndarray]):
        self.sets = [frozenset(words.tolist()) for words in lexicons]
        self.found: dict[str, tuple] = {}

    def _entries(self, word: str) -> tuple:
        found = self.found.get(word)
        if found is None:
            buckets = _word_buckets(word)
            found = tuple((k, b) for k, words in enumerate(self.sets) for b in buckets if b in words)
            if len(self.found) < KEPT_WORDS and len(word) <= 64:
                self.found[word] = found
        return found

    def votes(self, text: str) -> list[int]:
        hits: list[set[int]] = [set() for _ in self.sets]
        for word in set(_WORD.findall(text.lower())):
            for k, b in self._entries(word):
                hits[k].add(b)
        return [int(len(h) >= 2) if words else -1 for h, words in zip(hits, self.sets, strict=True)]


def toxic_votes(found: np.ndarray, lexicons: list[np.ndarray]) -> list[int]:
    return [int(np.isin(found, words, assume_unique=True).sum() >= 2) if len(words) else -1 for words in lexicons]


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _text, junk, toxic, keep`` for every row; no shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sent.value.scores(t) for t in batch["_text"]]
            junk, toxic = np.array([f[0] for f in found]), np.array([f[1] for f in found])
            yield pd.DataFrame({"_id": batch["_id"].astype("Int64"), "junk": junk, "toxic": toxic, "keep": (junk < JUNK_AT) & (toxic < TOXIC_AT)})

    return _slim(df, id_col, text_col).mapInPandas(run, "_id long, junk double, toxic double, keep boolean")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``df``: id, ``junk``, ``toxic`` (probabilities) and ``keep``.

    Null and empty texts get no votes and score as the bias alone; without labels, or with none that match, toxicity has no evidence and only
    what the heuristics say decides nothing: all is kept.  Repeated rows score alike; of labels that repeat an
    id the worst counts, null labels count as unknown; further columns are left out; empty gives empty."""
    model = train(df, labels, id_col, text_col, sample_rows)
    return scored(df, model, id_col, text_col).withColumnRenamed("_id", id_col)


# Keys of two numbers: some 25 MB.
KEYS_BROADCAST = 500_000


def kept(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``df``, all their columns, that the classifier keeps.

    Texts are scored by themselves, so that no task holds whole rows beside them; the keys of what goes are then taken
    out.  Nulls, repeated rows and empty tables as in ``classify``."""
    sent = df.sparkSession.sparkContext.broadcast(train(df, labels, id_col, text_col, sample_rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [sent.value.scores(t) for t in batch["_text"]]
            out = np.array([junk >= JUNK_AT or toxic >= TOXIC_AT for junk, toxic in scores], bool)
            yield batch.loc[out, ["_k1", "_k2"]]

    gone = keyed(df, id_col, text_col).select("_k1", "_k2", "_text").mapInPandas(run, "_k1 long, _k2 long").distinct()
    gone = stored(gone, "rejected").toDF("_key_one", "_key_two")
    gone = F.broadcast(gone) if gone.count() <= KEYS_BROADCAST else gone
    one, two = key_columns(df, id_col, text_col)
    return df.join(gone, (one == gone["_key_one"]) & (two == gone["_key_two"]), "left_anti")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
