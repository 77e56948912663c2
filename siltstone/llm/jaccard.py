"""Exact Jaccard join on word shingles: size-banded tiles, bitmap signatures, sorted arrays.

Nodes are distinct shingle sets, so exact copies cost one node.  Shingles have one total order: by a
count kept in a table of fixed size (rare first), then by hash.  Two sets of similarity t share a
shingle among the first n - ceil(t n) + 1 of each, so only those prefixes are shuffled.

Which pairs are compared:

1. Star rounds: each node goes to the group of one other node, the one it meets most often.  Within
   a block of a group, nodes that a link has brought together are not compared again, so groups
   of near copies join up without all their pairs.
2. Tiles: nodes of one shingle and size band that are still in different components.  A shingle whose nodes all
   are in one component by now needs no more pairs, so a large group of copies is never paired out; a
   large shingle is dealt into blocks of bounded size, and pairs of blocks are tiles.

In both, equal bits of the signatures bound the overlap from above; what may reach the threshold is
decided by intersecting the sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import components, key_columns, keyed, mixed, one_of_each, run_hashes, stored, table, word_hashes

WORDS, PERCENT = 5, 80
# The table of shingle counts has this many cells, whatever the size of the corpus (4 MB), and is
# sent in chunks.
CELLS, CHUNKS = 1 << 20, 64
STAR_ROUNDS = 1
# Nodes of a group, and items of their sets (32 MB), that are compared in one task.
BLOCK_NODES, BLOCK_ITEMS = 4096, 4_000_000
# A shingle with more nodes than this is compared in tiles of two blocks of this many.
TILE_ROWS = 512
# So many keys of three numbers are broadcast at most (some 30 MB), else Spark joins as it sees fit.
KEYS_BROADCAST = 500_000


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``words`` make one shingle."""
    hashes = word_hashes(text.encode().lower().split())  # lowers A-Z only
    return np.unique(run_hashes(hashes, min(words, len(hashes)))) if len(hashes) else hashes


def fingerprint(items: np.ndarray) -> int:
    place = np.arange(len(items), dtype=np.uint64)
    return int(np.bitwise_xor.reduce(mixed(items + place)) if len(items) else 0) ^ (len(items) * 0x9E3779B97F4A7C15 & (2**64 - 1))


def least_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def signature(items: np.ndarray) -> bytes:
    """A bit per hash bucket; two to four buckets per item, so a power of two, at least 64."""
    bits = max(64, 1 << int(2 * len(items) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(items & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The signature of the same items with ``size`` bytes: halves are laid over each other."""
    words = np.frombuffer(bits, np.uint64)
    while 8 * len(words) > size:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


def most_overlap(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes) -> int:
    """An item in one set only sets a bit that differs, unless another item hides it: so the overlap
    is at most half of both sizes less the differing bits."""
    size = min(len(bits_a), len(bits_b))
    differ = int(np.bitwise_count(folded(bits_a, size) ^ folded(bits_b, size)).sum())
    return min(n_a, n_b, (n_a + n_b - differ) // 2)


def _may_reach(n: int, x: bytes, m: int, y: bytes, percent: int) -> bool:
    if 100 * min(n, m) < percent * max(n, m):
        return False
    most = most_overlap(n, x, m, y)
    return 100 * most >= percent * (n + m - most)


def _reach(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _joined(group: list[tuple], percent: int) -> list[tuple]:
    """Links that join up a bounded group of (node, component, size, set, signature): each node is
    compared with the parts found so far, one member after the other, until one links."""
    links, parts = [], {}  # parts by component: members, latest first
    for row in group:
        node, own, n, items, bits = row
        for c in list(parts):
            if c == own:
                continue
            for other, _, m, y, y_bits in reversed(parts[c]):
                if _may_reach(n, bits, m, y_bits, percent) and _reach(items, y, percent):
                    links.append((min(node, other), max(node, other)))
                    parts[own] = parts.pop(c) + parts.get(own, [])
                    break
        parts.setdefault(own, []).append(row)
    return links


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """Per row of ``docs``: key, ``_n`` shingles, ``_node``; per task: its counts in chunks ``_chunk, _counts``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(CELLS, np.uint32)
        for batch in batches:
            sizes, nodes = [], []
            for text in batch["_text"]:
                items = shingles(text, words)
                sizes.append(len(items))
                nodes.append(_signed(fingerprint(items)))
                np.add.at(counts, (items >> np.uint64(40)).astype(np.int64) % CELLS, 1)
            yield pd.DataFrame({"_k1": batch["_k1"], "_k2": batch["_k2"], "_id": batch["_id"].astype("Int64"), "_n": sizes, "_node": nodes, "_chunk": None, "_counts": None})
        parts = counts.reshape(CHUNKS, -1)
        used = [i for i in range(CHUNKS) if parts[i].any()]
        none = pd.array([None] * len(used), dtype="Int64")
        yield pd.DataFrame({"_k1": none, "_k2": none, "_id": none, "_n": none, "_node": none, "_chunk": used, "_counts": [parts[i].tobytes() for i in used]})

    schema = "_k1 long, _k2 long, _id long, _n long, _node long, _chunk int, _counts binary"
    return stored(docs.select("_k1", "_k2", "_id", "_text").mapInPandas(run, schema), "profile")


def _order(profile: DataFrame) -> np.ndarray:
    """Counts of all tasks added up: CELLS numbers, whatever the corpus."""

    def add(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CELLS // CHUNKS, np.uint64)
        for batch in batches:
            for c in batch["_counts"]:
                total += np.frombuffer(c, np.uint32)
        yield pd.DataFrame({"_chunk": [key[0]], "_counts": [total.tobytes()]})

    parts = profile.where("_chunk IS NOT NULL").select("_chunk", "_counts")
    order = np.zeros((CHUNKS, CELLS // CHUNKS), np.uint64)
    for row in parts.groupBy("_chunk").applyInPandas(add, "_chunk int, _counts binary").collect():
        order[row["_chunk"]] = np.frombuffer(row["_counts"], np.uint64)
    return order.reshape(-1)


def _prefixes(docs: DataFrame, order: np.ndarray, words: int, percent: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = sent.value
        for batch in batches:
            found, nodes, sizes, totals = [], [], [], []
            for text in batch["_text"]:
                items = shingles(text, words)
                if not len(items):
                    continue
                take = len(items) - least_overlap(len(items), percent) + 1
                first = np.lexsort((items, rank[(items >> np.uint64(40)).astype(np.int64) % CELLS]))[:take]
                found.append(items[first])
                nodes.append(_signed(fingerprint(items)))
                sizes.append(take)
                totals.append((len(items) << 32) + np.arange(1, take + 1))
            items = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            totals = np.concatenate(totals) if totals else items
            yield pd.DataFrame({"_shingle": items, "_node": np.repeat(np.array(nodes, np.int64), sizes), "_place": totals})

    return docs.select("_text").mapInPandas(run, "_shingle long, _node long, _place long")


def _shared(prefixes: DataFrame) -> DataFrame:
    """Distinct ``_shingle, _node, _n, _p`` (size, place in the prefix from 1) of the shingles with several
    nodes, told from their neighbours in sorted order, so that no task holds a shingle's nodes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = np.zeros((0, 3), np.int64)  # the row that waits for its successor
        joined = False  # it belongs with the row before it
        for batch in batches:
            rows = np.vstack([last, batch.to_numpy(np.int64)])
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            rows = rows[new]
            same = np.zeros(len(rows), bool)
            same[1:] = rows[1:, 0] == rows[:-1, 0]
            if len(last):
                same[0] = joined
            keep = same[:-1] | same[1:]
            out = rows[:-1][keep]
            last, joined = rows[-1:], bool(same[-1]) if len(rows) else joined
            yield pd.DataFrame(out, columns=names)
        if joined and len(last):
            yield pd.DataFrame(last, columns=names)

    names = ["_shingle", "_node", "_place"]
    rows = prefixes.repartition("_shingle").sortWithinPartitions("_shingle", "_node").mapInPandas(run, prefixes.schema)
    return rows.select("_shingle", "_node", F.shiftright("_place", 32).alias("_n"), F.col("_place").bitwiseAND((1 << 32) - 1).alias("_p"))


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= KEYS_BROADCAST else keys


class _Join:
    """The steps of one join that share its stored tables."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent = docs, words, percent
        profile = _profile(docs, words)
        self.rows = profile.where("_chunk IS NULL").select("_k1", "_k2", "_id", "_n", "_node")
        firsts = [F.first(c).alias(c) for c in ("_k1", "_k2")]
        self.nodes = stored(self.rows.where("_n > 0").groupBy("_node").agg(*firsts), "nodes")
        self.shared = stored(_shared(_prefixes(docs, _order(profile), words, percent)), "shared")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``_node, _set, _bits`` (sorted array and signature) of some distinct nodes."""
        words = self.words
        nodes = _small(stored(nodes, "wanted"))
        keys = stored(self.nodes.select("_node", "_k1", "_k2").join(nodes, "_node"), "keys")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                items = [shingles(t, words) for t in batch["_text"]]
                yield pd.DataFrame({"_node": batch["_node"], "_set": [i.tobytes() for i in items], "_bits": [signature(i) for i in items]})

        texts = self.docs.select("_k1", "_k2", "_text").join(_small(keys), ["_k1", "_k2"]).select("_node", "_text")
        held = texts.mapInPandas(run, "_node long, _set binary, _bits binary")
        return stored(held.dropDuplicates(["_node"]), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs ``a, b`` of nodes whose sets reach the threshold."""
        percent = self.percent
        pairs = stored(pairs, "pairs")
        held = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct())

        def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = [_may_reach(n, x, m, y, percent) for n, x, m, y in zip(batch["n"], batch["x"], batch["m"], batch["y"], strict=True)]
                yield batch.loc[np.array(keep, bool), ["a", "b"]]

        def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = [_reach(x, y, percent) for x, y in zip(batch["x"], batch["y"], strict=True)]
                yield batch.loc[np.array(keep, bool), ["a", "b"]]

        small = held.select("_node", (F.octet_length("_set") / 8).cast("long").alias("_n"), "_bits")
        left = small.select(F.col("_node").alias("a"), F.col("_n").alias("n"), F.col("_bits").alias("x"))
        right = small.select(F.col("_node").alias("b"), F.col("_n").alias("m"), F.col("_bits").alias("y"))
        maybe = pairs.join(left, "a").join(right, "b").mapInPandas(bounded, "a long, b long")
        left = held.select(F.col("_node").alias("a"), F.col("_set").alias("x"))
        right = held.select(F.col("_node").alias("b"), F.col("_set").alias("y"))
        return stored(maybe.join(left, "a").join(right, "b").mapInPandas(exact, "a long, b long"), "links")

    def within(self, groups: DataFrame, turn: int) -> DataFrame:
        """Links that join up the nodes of each group ``_hub, _node, _n, _c``; nodes already in one
        component are not compared, nor any that a found link brings together.

        A large group is dealt into blocks of bounded size, otherwise in the next round."""
        percent = self.percent
        groups = stored(groups, "groups")
        sizes = groups.groupBy("_hub").agg(F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("_n") / BLOCK_ITEMS)).alias("_blocks"))
        held = self.sets(groups.select("_node").distinct())
        rows = groups.join(sizes, "_hub").withColumn("_block", F.pmod(F.xxhash64(F.lit(turn), "_node"), "_blocks")).join(held, "_node")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            key, group = None, []
            for batch in batches:
                out = []
                for r in batch.itertuples(index=False):
                    if (r.hub, r.block) != key:
                        out += _joined(group, percent)
                        key, group = (r.hub, r.block), []
                    group.append((r.node, r.c, len(r.set) // 8, r.set, r.bits))
                yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
            yield pd.DataFrame(_joined(group, percent), columns=["a", "b"], dtype="int64")

        rows = rows.repartition("_hub", "_block").sortWithinPartitions("_hub", "_block", "_node")
        rows = rows.select(*[F.col(f"_{c}").alias(c) for c in ("hub", "block", "node", "c", "set", "bits")])
        return stored(rows.mapInPandas(run, "a long, b long"), "links")

    def grouped(self, links: DataFrame | None) -> DataFrame:
        """``_shingle, _node, _n, _c`` (component) of shingles whose nodes are in several components."""
        rows = self.shared
        if links is None:
            return rows.withColumn("_c", F.col("_node"))
        found = components(links).select(F.col("id").alias("_node"), "component")
        rows = rows.join(_small(stored(found, "found")), "_node", "left").withColumn("_c", F.coalesce("component", "_node")).drop("component")
        open_ = rows.groupBy("_shingle").agg(F.min("_c").alias("_p"), F.max("_c").alias("_q")).where("_p != _q").select("_shingle")
        return stored(rows.join(open_, "_shingle", "left_semi"), "open")

    def star(self, rows: DataFrame, turn: int) -> DataFrame:
        """Groups ``_hub, _node, _n, _c``: each node with the other it meets most often among the firsts of its
        shingles, if that is in a quarter of its prefix.  First is the least by a hash of this round: the
        same for all shingles, so copies choose the same hub.  For nodes in the first's component, the first of
        another component stands in."""
        rank = F.struct(F.xxhash64(F.lit(turn), "_node").alias("r"), F.col("_c").alias("c"), F.col("_node").alias("v"), F.col("_n").alias("n"))
        rows = rows.withColumn("_r", rank)
        rows = rows.join(rows.groupBy("_shingle").agg(F.min("_r").alias("_f")), "_shingle")
        second = rows.where("_c != _f.c").groupBy("_shingle").agg(F.min("_r").alias("_g"))
        rows = rows.join(second, "_shingle")
        other = F.when(F.col("_c") != F.col("_f.c"), F.col("_f")).otherwise(F.col("_g"))
        met = rows.select("_node", "_n", "_c", other.alias("_o"))
        close = F.least("_n", "_o.n") * 100 >= F.greatest("_n", "_o.n") * self.percent
        votes = met.where(close).groupBy("_node", "_n", "_c", F.col("_o.v").alias("_v"), F.col("_o.c").alias("_d"), F.col("_o.n").alias("_m")).agg(F.count("*").alias("_votes"))
        votes = votes.where(F.col("_votes") * 4 * 100 >= F.col("_n") * (100 - self.percent))
        best = votes.groupBy("_node", "_n", "_c").agg(F.max(F.struct("_votes", "_v", "_d", "_m")).alias("_b"))
        hubs = best.select(F.col("_b._v").alias("_hub"), F.col("_b._v").alias("_node"), F.col("_b._m").alias("_n"), F.col("_b._d").alias("_c"))
        return best.select(F.col("_b._v").alias("_hub"), "_node", "_n", "_c").unionByName(hubs).distinct()

    def tiles(self, rows: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of nodes of one shingle, in different components, of sizes and places that may match.

        A node stands in the band of its size and, as a guest, in the next; a pair meets where one is at home."""
        band = F.floor(F.log(F.col("_n").cast("double")) / np.log(100 / self.percent * 1.001)).cast("int")
        rows = rows.withColumn("_band", band)
        sizes = rows.groupBy("_shingle").agg(F.count("*").alias("_rows"))
        sizes = sizes.withColumn("_blocks", F.ceil(F.col("_rows") / TILE_ROWS).cast("int"))
        rows = rows.join(sizes, "_shingle").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
        home = rows.select("*", F.lit(False).alias("_guest"))
        guest = rows.withColumn("_band", F.col("_band") + 1).withColumn("_guest", F.lit(True))
        every = home.unionByName(guest)
        # The pair of blocks (i, j) is a tile: homes of block i against homes and guests of block j.
        left = home.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select("_shingle", "_band", F.col("_block").alias("_i"), "_j", F.col("_node").alias("a"), F.col("_n").alias("n"), F.col("_p").alias("p"), F.col("_c").alias("c"))
        right = every.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select("_shingle", "_band", "_i", F.col("_block").alias("_j"), F.col("_node").alias("b"), F.col("_n").alias("m"), F.col("_p").alias("q"), F.col("_c").alias("d"), "_guest")
        met = left.join(right, ["_shingle", "_band", "_i", "_j"])
        # From the first shingle that both hold on, they share at most what follows it in each.
        most = 1 + F.least(F.col("n") - F.col("p"), F.col("m") - F.col("q"))
        close = 100 * most >= self.percent * (F.col("n") + F.col("m") - most)
        pairs = met.where((F.col("c") != F.col("d")) & close & (F.col("_guest") | (F.col("a") < F.col("b"))))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _grouped_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``_k1, _k2, _id, _n, _node, _c`` (component) of keyed documents."""
    join = _Join(docs, words, percent)
    links = None
    for turn in range(STAR_ROUNDS):
        more = join.within(join.star(join.grouped(links), turn), turn)
        links = more if links is None else links.unionByName(more)
    links = links.unionByName(join.links(join.tiles(join.grouped(links))))
    found = components(links).select(F.col("id").alias("_node"), "component")
    return stored(join.rows.join(_small(stored(found, "found")), "_node", "left").withColumn("_c", F.coalesce("component", "_node")).drop("component"), "grouped")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df``, all their columns, of one document per component: the one with the smallest id
    (null last), then text hash; of rows that repeat its id and text one stays.  Texts without words all stay; empty gives empty;
    very long texts are compared whole."""
    rows = _grouped_rows(keyed(df, id_col, text_col), words, percent)
    best = rows.where("_n > 0").groupBy("_c").agg(F.min(F.struct("_k1", "_k2")).alias("_best"))
    gone = rows.where("_n > 0").join(best, "_c").where(F.struct("_k1", "_k2") != F.col("_best")).select("_k1", "_k2").distinct()
    gone = _small(stored(gone, "copies").toDF("_key_one", "_key_two"))
    one, two = key_columns(df, id_col, text_col)
    return one_of_each(df.join(gone, (one == gone["_key_one"]) & (two == gone["_key_two"]), "left_anti"), id_col, text_col)


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``df``: id, ``n_shingles``, ``component_id``, the smallest id reachable over links.

    Two rows link when 100 * overlap >= percent * union of their sets of distinct shingles of ``words`` words
    (A-Z lowered); a text of fewer words is one shingle.  Texts that are null, empty or blank have no shingles and link with nothing:
    they are their own component.  Rows that repeat a text are linked; rows of one id with different texts
    are answered each.  Rows without an id take part, but never name a component unless alone.  Further
    columns are left out; empty gives empty."""
    rows = _grouped_rows(keyed(df, id_col, text_col), words, percent)
    least = rows.where("_n > 0").groupBy("_c").agg(F.min("_id").alias("_least"))
    rows = rows.join(least, "_c", "left")
    own = F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_id"))
    return rows.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), own.alias("component_id"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: their component, exactly."""
    return jaccard_groups(table(spark, sf_dir, "documents"))
