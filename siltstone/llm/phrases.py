"""Phrase collocation mining after Toivonen: a sample proposes, full passes count exactly.

A sample of all occurrences proposes frequent phrases, with a threshold lowered so far that few are missed.  A full pass
counts these and their negative border, the phrases whose first and last words but one are all proposed:
every frequent phrase is either among them or longer than a frequent one of the border.  If the border
turns out to hold frequent phrases, they are added and a further pass counts what that brings into reach, until
nothing is new.  So the result is exact, whatever the sample was.

Before all, pairs of words are counted in a fixed number of buckets by hash: a pair whose bucket stays below the
threshold can't be frequent, and is neither proposed nor counted.  That, too, only saves work.

Proposals travel to the tasks as a bit field of fixed size over hashes.  Different phrases that share a bit make
tasks count a few more phrases; the counts themselves are kept by the phrase's text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import mixed, stored, table

LEAST = 100  # occurrences of a phrase
LONGEST = 5
TOP = 2000

# The marks that end a piece become one of them, tabs become spaces, A-Z become a-z.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 46 if c in _ENDS else 32 if c == 9 else c for c in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """What decides how the work is done, but never the result."""

    sample: int = 4  # one occurrence of so many counts for the proposals
    sigmas: float = 3.5  # the sample's threshold lies so many standard deviations below its share of the least count
    bits: int = 26  # the bit field has 2**bits bits
    buckets: int = 22  # pairs of words are counted together in 2**buckets buckets first
    chunk_bytes: int = 4_000_000  # text that is looked at together
    entries: int = 1_000_000  # phrases that a task holds before it hands some over
    words: int = 500_000  # words that a task numbers before it begins anew


class _Language:
    """The words of one language that a task has met, and their hashes."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.clear()

    def clear(self) -> None:
        self.numbers, self.hashes = {b".": 0}, np.zeros(1, np.uint64)

    def read(self, text: bytes) -> np.ndarray:
        """The text as word numbers, with 0 at the end of each piece."""
        marks = np.frombuffer(text.translate(_BYTES), np.uint8)
        ends = marks == 46
        inside = np.concatenate([[False], (marks != 32) & ~ends, [False]])
        bounds = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = bounds[::2], bounds[1::2]
        # The words' bytes without what lies between them, as an Arrow array: numbered there, one by one.
        offsets = np.concatenate([[0], np.cumsum(stops - starts)])
        joined = marks[inside[1:-1]]
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]
        ).dictionary_encode()
        data, cuts = words.dictionary.buffers()[2].to_pybytes(), np.frombuffer(words.dictionary.buffers()[1], np.int64)
        cuts = cuts[: len(words.dictionary) + 1].tolist()
        known, new = [], []
        for word in [data[a:b] for a, b in zip(cuts, cuts[1:])]:
            number = self.numbers.get(word)
            if number is None:
                number = self.numbers[word] = len(self.numbers)
                new.append(xxhash.xxh3_64_intdigest(word, self.seed))
            known.append(number)
        self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        before = np.concatenate([[0], np.cumsum(ends)])
        out = np.zeros(len(starts) + before[-1], np.int32)
        out[np.arange(len(starts)) + before[starts]] = np.array(known, np.int32)[words.indices.to_numpy()]
        return out


def _bits(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set."""
    at = hashes >> np.uint64(64 - (len(field) * 8).bit_length() + 1)
    return (field[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _lengthened(shorter: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those without their last word and from the hashes of that word."""
    return mixed(shorter * _MUL + last)


def _phrases(numbers: np.ndarray, hashes: np.ndarray, wanted, heavy: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, hashes, starts`` of the phrases of every size: hashes of all places, and the places that ``wanted`` chooses.

    ``wanted(size, hashes one shorter, those chosen one shorter)`` marks which places of the shorter size may be
    the begin or the end of a phrase; None lets all phrases pass.  Pairs must have their bit in ``heavy``."""
    words = hashes[numbers]
    current, whole = words, numbers > 0
    chosen = whole
    for size in range(1, LONGEST + 1):
        if size > 1:
            if len(current) < 2:
                return
            marks = wanted(size, current, chosen)
            whole = whole[:-1] & (numbers[size - 1 :] > 0)
            chosen = whole if marks is None else whole & marks
            current = _lengthened(current[:-1], words[size - 1 :])
            if size == 2 and heavy is not None:
                chosen = chosen & _bits(heavy, current)
        at = np.flatnonzero(chosen)
        yield size, current, at


class _Counts:
    """Phrases of a task with their counts, by hash, and the words they consist of."""

    def __init__(self):
        self.held: dict[tuple[str, int], list] = {}
        self.size = 0

    def add(self, lang: str, size: int, hashes: np.ndarray, numbers: np.ndarray | None = None, at: np.ndarray | None = None) -> None:
        if len(hashes):
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            counts = np.diff(np.append(first, len(ordered)))
            words = None if numbers is None else numbers[at[order[first]][:, None] + np.arange(size)]
            self.held.setdefault((lang, size), []).append((ordered[first], counts, words))
            self.size += len(first)

    def settle(self) -> None:
        """Adds up what came from several chunks."""
        self.size = 0
        for key, parts in self.held.items():
            hashes, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            words = None if parts[0][2] is None else np.concatenate([p[2] for p in parts])[order[first]]
            self.held[key] = [(ordered[first], np.add.reduceat(counts[order], first), words)]
            self.size += len(first)


def _chunks(batch: pd.DataFrame, most: int) -> Iterator[tuple[str, bytes]]:
    """Texts of one language after the other, joined up to about ``most`` bytes."""
    for lang, texts in batch.groupby("_lang", sort=True)["_text"]:
        waiting, size = [], 0
        for text in texts:
            waiting.append(text.encode("utf-8", "surrogatepass"))
            size += len(waiting[-1])
            if size >= most:
                yield lang, b".".join(waiting)
                waiting, size = [], 0
        yield lang, b".".join(waiting)


def _sampled(at: np.ndarray, text: bytes, one_in: int) -> np.ndarray:
    """One place in ``one_in``, chosen by hash: each occurrence of a phrase for itself, however close together."""
    key = mixed(at.astype(np.uint64) + np.uint64(xxhash.xxh3_64_intdigest(text)))
    return at[key % np.uint64(one_in) == 0]


PARTS = 1024


def _heavy(docs: DataFrame, least: int, given: Settings) -> np.ndarray:
    """A bit per bucket of pairs: whether all its pairs together occur ``least`` times.

    Every task hands over one array in parts, which are added up as they come."""
    size = 2**given.buckets
    parts = min(PARTS, size // 8)
    kind = np.dtype(np.uint8 if least <= 255 else np.uint32)  # counts beyond ``least`` say no more than ``least``

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, languages = np.zeros(size, np.int64), {}
        for batch in batches:
            for lang, text in _chunks(batch, given.chunk_bytes):
                known = languages.setdefault(lang, _Language(lang))
                for length, hashes, at in _phrases(known.read(text), known.hashes, lambda *_: None):
                    if length == 2:
                        counts += np.bincount((hashes[at] >> np.uint64(64 - given.buckets)).astype(np.int64), minlength=size)
                        break
                if len(known.numbers) > given.words:
                    known.clear()
        held = np.minimum(counts, least).astype(kind).reshape(parts, -1)
        yield pd.DataFrame({"part": np.arange(parts), "counts": pd.Series([row.tobytes() for row in held], dtype=object)})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"], batch["counts"]):
                more = np.frombuffer(counts, kind).astype(np.int64)
                total[part] = total[part] + more if part in total else more
        bits = [np.packbits(c >= least, bitorder="little").tobytes() for c in total.values()]
        yield pd.DataFrame({"part": pd.Series([*total], dtype="int64"), "bits": pd.Series(bits, dtype=object)})

    rows = docs.mapInPandas(run, "part long, counts binary").repartition("part").mapInPandas(add, "part long, bits binary")
    out = np.zeros((parts, size // 8 // parts), np.uint8)
    for row in rows.collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _proposed(docs: DataFrame, field: np.ndarray | None, heavy: np.ndarray, given: Settings) -> DataFrame:
    """``h, n``: hashes and counts of phrases in the sample; of one or two words without ``field``, else of more
    whose pairs of words are all in ``field``."""
    sent = docs.sparkSession.sparkContext.broadcast((field, heavy))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (field, heavy), counts, languages = sent.value, _Counts(), {}

        def wanted(size: int, shorter: np.ndarray, chosen: np.ndarray) -> np.ndarray | None:
            if field is None or size < 3:
                return None
            pairs = chosen & _bits(field, shorter) if size == 3 else chosen
            return pairs[:-1] & pairs[1:]

        def out() -> Iterator[pd.DataFrame]:
            for parts in counts.held.values():
                for hashes, n, _ in parts:
                    yield pd.DataFrame({"h": hashes.view(np.int64), "n": n})
            counts.held, counts.size = {}, 0

        for batch in batches:
            for lang, text in _chunks(batch, given.chunk_bytes):
                known = languages.setdefault(lang, _Language(lang))
                for size, hashes, at in _phrases(known.read(text), known.hashes, wanted, heavy):
                    if (size < 3) == (field is None):
                        counts.add("", 0, hashes[_sampled(at, text, given.sample)])
                    elif field is None:
                        break
                if len(known.numbers) > given.words:
                    known.clear()
                if counts.size > given.entries:
                    counts.settle()
                    if counts.size > given.entries // 2:
                        yield from out()
        counts.settle()
        yield from out()

    return docs.mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _rows(lang: list[str], size: int, phrases: list[str], f: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"lang": pd.Series(lang, dtype=object), "size": size, "phrase": pd.Series(phrases, dtype=object), "f": f})


def _counted(docs: DataFrame, field: np.ndarray, before: np.ndarray | None, heavy: np.ndarray, given: Settings) -> DataFrame:
    """``lang, size, phrase, f``: all words (unless counted ``before``) and the longer phrases that ``field`` brings
    into reach and ``before`` did not.  Size 0 holds the number of words of the language."""
    sent = docs.sparkSession.sparkContext.broadcast((field, before, heavy))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (field, before, heavy), counts, languages, totals = sent.value, _Counts(), {}, {}

        def wanted(size: int, shorter: np.ndarray, chosen: np.ndarray) -> np.ndarray:
            now = _bits(field, shorter)
            marks = now[:-1] & now[1:]
            if before is not None:
                then = _bits(before, shorter)
                marks &= ~(then[:-1] & then[1:])
            return marks

        def out() -> Iterator[pd.DataFrame]:
            for (lang, size), parts in counts.held.items():
                words = [w.decode("utf-8", "surrogatepass") for w in languages[lang].numbers]
                for _, n, rows in parts:
                    for a in range(0, len(n), 100_000):
                        texts = [" ".join(map(words.__getitem__, row)) for row in rows[a : a + 100_000].tolist()]
                        yield _rows([lang] * len(texts), size, texts, n[a : a + 100_000])
            counts.held, counts.size = {}, 0

        for batch in batches:
            for lang, text in _chunks(batch, given.chunk_bytes):
                known = languages.setdefault(lang, _Language(lang))
                numbers = known.read(text)
                if before is None:
                    totals[lang] = totals.get(lang, 0) + int((numbers > 0).sum())
                for size, hashes, at in _phrases(numbers, known.hashes, wanted, heavy):
                    if size > 1 or before is None:
                        counts.add(lang, size, hashes[at], numbers, at)
                if counts.size > given.entries or len(known.numbers) > given.words:
                    counts.settle()
                    if counts.size > given.entries // 2 or len(known.numbers) > given.words:
                        yield from out()
                        for other in languages.values():
                            if len(other.numbers) > given.words:
                                other.clear()
        counts.settle()
        yield from out()
        yield _rows([*totals], 0, [""] * len(totals), np.array([*totals.values()], np.int64))

    rows = docs.mapInPandas(run, "lang string, size int, phrase string, f long")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _field(hashes: DataFrame, bits: int, known: np.ndarray | None = None) -> np.ndarray:
    """The bit field of the hashes ``h``, with what ``known`` has set: built in parts by the tasks; the driver gets the
    finished parts, 2**``bits`` bits in all."""
    parts = 64
    size = 2**bits // 8 // parts
    part = F.shiftrightunsigned("h", 58).cast("int")
    # Only distinct bits travel: at most 2**bits of them, however many hashes there are.
    bit = F.shiftrightunsigned("h", 64 - bits)
    travelling = hashes.select(part.alias("part"), bit.alias("bit")).distinct()

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros(size * 8, bool)
        mask[rows["bit"].to_numpy() - int(key[0]) * size * 8] = True
        return pd.DataFrame({"part": [key[0]], "bits": [np.packbits(mask, bitorder="little").tobytes()]})

    out = np.zeros(2**bits // 8, np.uint8) if known is None else known.copy()
    for row in travelling.groupBy("part").applyInPandas(build, "part int, bits binary").collect():
        out[row["part"] * size : (row["part"] + 1) * size] |= np.frombuffer(row["bits"], np.uint8)
    return out


def _hashed(phrases: DataFrame) -> DataFrame:
    """``h`` of stored phrases, as the passes compute it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (lang, size), rows in batch.groupby(["lang", "size"]):
                seed = _Language(lang).seed
                words = [[xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in p.split(" ")] for p in rows["phrase"]]
                each = np.array(words, np.uint64).reshape(len(rows), size)
                hashes = each[:, 0]
                for k in range(1, size):
                    hashes = _lengthened(hashes, each[:, k])
                yield pd.DataFrame({"h": hashes.view(np.int64)})

    return phrases.select("lang", "size", "phrase").mapInPandas(run, "h long")


def _outside(hashes: DataFrame, field: np.ndarray) -> int:
    """How many of the hashes the field lacks."""
    sent = hashes.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [int((~_bits(sent.value, batch["h"].to_numpy().view(np.uint64))).sum())]})

    return hashes.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def frequent(docs: DataFrame, least: int = LEAST, given: Settings = Settings()) -> DataFrame:
    """``lang, size, phrase, f`` of every phrase of 1 to LONGEST words that occurs ``least`` times in its language;
    size 0 holds the number of words.  ``docs`` has ``_lang`` and ``_text``, neither null."""
    share = least / given.sample
    lowered = max(2, math.floor(share - given.sigmas * math.sqrt(share)))
    heavy = _heavy(docs, least, given)
    field = _field(_proposed(docs, None, heavy, given).where(F.col("n") >= lowered), given.bits)
    field = _field(_proposed(docs, field, heavy, given).where(F.col("n") >= lowered), given.bits, field)
    found, before = [], None
    while True:
        new = stored(_counted(docs, field, before, heavy, given).where((F.col("f") >= least) | (F.col("size") == 0)), "phrases")
        found.append(new)
        border = stored(_hashed(new.where(F.col("size").between(1, LONGEST - 1))), "border")
        if not _outside(border, field):
            break
        field, before = _field(border, given.bits, field), field
    out = found[0]
    for new in found[1:]:
        out = out.unionByName(new)
    return out


def _joined(words, a, b):
    return F.array_join(F.slice(words, a, b), " ")


def collocations(
    df: DataFrame, top: int = TOP, least: int = LEAST, text_col: str = "text", lang_col: str = "lang", given: Settings = Settings()
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to LONGEST words of every language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its first and second part at the cut that scores lowest
    (the earliest of these), ``n`` the words of the language.  A phrase inside a longer one that occurs as often is
    left out.  Equal scores come by falling count, then by phrase in byte order.

    Null texts have no words, a null language is ``und``; repeated rows and repeated ids count each; very long texts
    are read whole; further columns are left out; an empty table gives an empty result.

    Tasks add up their phrases before the shuffle, so a phrase that is everywhere arrives once per task."""
    docs = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    known = stored(frequent(docs, least, given), "frequent")
    words = F.split("phrase", " ")
    totals = known.where("size = 0").select("lang", F.col("f").alias("n"))
    each = known.where("size > 0").select("lang", "phrase", "f")
    longer = known.where("size > 1")
    cuts = longer.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumns({"_first": _joined(words, F.lit(1), F.col("cut")), "_rest": _joined(words, F.col("cut") + 1, F.col("size") - F.col("cut"))})
    cuts = cuts.join(each.toDF("lang", "_first", "l"), ["lang", "_first"]).join(each.toDF("lang", "_rest", "r"), ["lang", "_rest"])
    cuts = cuts.join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(18,0)") for c in "alnr"}
    score = cuts.withColumns({f"_{c}": v for c, v in exact.items()}).withColumn("score", F.expr("(1000 * (_a * _n)) div (_l * _r)"))
    lowest = F.struct("score", "cut", "l", "r")
    best = score.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(lowest).alias("_best"))

    inner = known.where("size > 2").select(
        "lang", F.col("f").alias("a"), F.explode(F.array(_joined(words, F.lit(1), F.col("size") - 1), _joined(words, F.lit(2), F.col("size") - 1))).alias("phrase")
    ).distinct()
    kept = best.join(inner, ["lang", "phrase", "a"], "left_anti")
    ranked = kept.select("lang", "phrase", "a", F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), "n", F.col("_best.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))
