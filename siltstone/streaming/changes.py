"""Applying a change stream to stored history, key by key, without row-level merge.

A batch writes rows of the keys it changes and of no others.  First, changes that are stored already are
dropped: a change later than all seen of its key is new, and only the rest is looked up in the change log, by key,
sequence and row digest.  Of what is left,

* keys whose changes all come after those seen need their open version only: it enters as a change at its start, and
  the versions that result are appended;
* keys with a late change are rebuilt from their rows of the change log, with the operator a batch job would use;
  versions that vanish are appended once more, marked as lost.

Readers take the newest row per open key and per closed version.  Only what came after the base (the first or
last folded load) takes part in that choice; rows of the base are left out by an anti-join.  Any split and any order of
arrival give the history of all changes together.  A batch becomes visible by one ledger row, so readers never see
half of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.columns import holds, null_safe_join
from siltstone.functions.order import row_digest
from siltstone.operators.cluster import by_folder, zorder
from siltstone.operators.conform import latest
from siltstone.operators.feed import history_feed
from siltstone.operators.history import DELETED, END, START, scd2
from siltstone.operators.skew import SPLIT_FLOOR
from siltstone.session import saved
from siltstone.sources.store import LoadStore
from siltstone.streaming.files import start_batches

BUCKET, OPEN, SEEN, GONE = "_bucket", "_open", "_seen", "_gone"
BATCH, LOST, KNOWN = "_batch", "_lost", "_known"


@dataclass(frozen=True)
class ChangeTarget:
    """A history (``scd_type`` 2) or latest-value (1) table named ``name`` in ``store``.

    Keys are spread over ``buckets`` folders, so that a batch reads those of its keys only.  The number is
    kept in the ledger and must not change during the life of the table.
    """

    store: LoadStore
    name: str
    keys: Sequence[str]
    sequence: str
    ties: Sequence[str] = ()
    deletes: str | None = None
    except_columns: Sequence[str] = ()
    tracked: Sequence[str] | None = None
    scd_type: int = 2
    buckets: int = 64
    split_floor: int | None = SPLIT_FLOOR
    fold_after: int = 200
    cluster_by: Sequence[str] = ()  # columns that folding clusters the table by, inside its folders

    @property
    def log(self) -> str:
        return f"{self.name}_changes"

    @property
    def _key(self) -> list[str]:
        return [*self.keys, BUCKET]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # -- applying --------------------------------------------------------------------------

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Applies one batch.  Running the same batch again changes nothing.

        ``changes`` is read several times, so it should come from stored rows."""
        load_id = f"b{batch_id:09d}"
        loads = self._loads()
        if self.store.committed(self.name, load_id):
            return
        rows = changes.withColumn(BUCKET, self._bucket())
        if self.scd_type == 1:
            out, late = self._newest(rows, loads, batch_id), 0
            folders = [BUCKET]
        else:
            if not self.store.committed(self.log, load_id):
                self.store.put(by_folder(self._fresh(rows, loads), [BUCKET]), self.log, load_id, partition_by=[BUCKET])
            [load] = self.store.load(self.log, load_id)
            out, late = self._changed(load, loads, batch_id) if load.rows else (None, 0)
            folders = [OPEN, BUCKET]
        if out is not None:
            facts = self.store.write(by_folder(out, folders), self.name, load_id, partition_by=folders)
            if facts["rows"]:
                self._commit(load_id, "incremental", late, facts)
        if len(loads) >= self.fold_after:
            self.fold()

    def _commit(self, load_id: str, strategy: str, late: int, facts: dict) -> None:
        self.store.commit(self.name, load_id, strategy, counts={"buckets": self.buckets, "late_keys": late}, **facts)

    def _loads(self) -> list:
        """The ledger rows of the table, read once per batch."""
        loads = self.store.visible(self.name)
        stored = {load.counts["buckets"] for load in loads if load.counts and "buckets" in load.counts}
        if stored - {self.buckets}:
            raise ValueError(f"{self.name} is stored in {stored.pop()} buckets, not {self.buckets}")
        return loads

    def _compared(self, rows: DataFrame) -> list[str]:
        """The columns that make a change what it is."""
        left_out = {*self.except_columns, BUCKET, BATCH, SEEN, KNOWN} - {*self.keys, self.sequence, *self.ties}
        return [c for c in rows.columns if c not in left_out]

    def _fresh(self, rows: DataFrame, loads: list) -> DataFrame:
        """``rows`` without changes the log already has."""
        touched = _numbers(rows)
        if not loads or not touched:
            return rows
        seen = self._known_keys(loads, touched)
        both = null_safe_join(rows, seen, self._key, "left")
        not_after = F.col(self.sequence).isNull() | (F.col(self.sequence) <= F.col(SEEN))
        both = both.withColumn(KNOWN, F.col(KNOWN).isNotNull() & F.coalesce(not_after, F.lit(False))).drop(SEEN)
        doubtful = _numbers(both.where(KNOWN))
        if not doubtful:
            return rows
        digest = row_digest(both.withColumn(GONE, self._gone()), [*self._compared(rows), GONE])
        both = both.withColumn(GONE, self._gone()).withColumn("_digest", digest).drop(GONE)
        log = self.store.read(self.log, where=_among(doubtful))
        stored = log.withColumn(GONE, self._gone())
        stored = stored.select(*self._key, self.sequence, row_digest(stored, [*self._compared(log), GONE]).alias("_digest"))
        # The log is only looked up in: what meets a doubtful change is about as much as there are of these.
        same = [*self._key, self.sequence, "_digest"]
        asked = both.where(KNOWN).select(*same).distinct()
        met = null_safe_join(stored, asked, same, "left_semi").distinct()
        late = null_safe_join(both.where(KNOWN), met, same, "left_anti")
        return both.where(~F.col(KNOWN)).unionByName(late).drop("_digest", KNOWN)

    def _known_keys(self, loads: list, touched: list[int]) -> DataFrame:
        """Key and last sequence value seen, of every stored key in the buckets."""
        opened = self.store.read(self.name, loads, where=f"{OPEN} AND {_among(touched)}")
        return opened.groupBy(*self._key).agg(F.max(SEEN).alias(SEEN)).withColumn(KNOWN, F.lit(True))

    def _newest(self, rows: DataFrame, loads: list, batch_id: int) -> DataFrame:
        """Type 1: the keys whose newest row is one of the batch."""
        marked = rows.withColumns({DELETED: self._gone(), BATCH: F.lit(batch_id).cast("bigint"), KNOWN: F.lit(False)})
        touched = _numbers(rows)
        if loads and touched:
            known = self._current(loads, _among(touched))
            known = null_safe_join(known, rows.select(*self._key).distinct(), self._key, "left_semi")
            marked = marked.unionByName(known.withColumn(KNOWN, F.lit(True)), allowMissingColumns=True)
        # Sequence and tie-breakers stay stored: later batches are compared with them.  Of equal rows the stored one wins.
        unused = [c for c in self.except_columns if c not in (self.sequence, *self.ties)]
        ties = [self.sequence, *self.ties]
        kept = latest(marked.drop(*[c for c in unused if c not in self.keys]), self._key, ties, ignored=[BATCH], last=[KNOWN])
        return kept.where(~F.col(KNOWN)).drop(KNOWN)

    def _changed(self, load, loads: list, batch_id: int) -> tuple[DataFrame, int]:
        """Rows to append for a logged batch of new changes, and the number of keys that had to be rebuilt."""
        batch = self.store.read(self.log, [load])
        events, late = self._events(batch), 0
        stamp = {BATCH: F.lit(batch_id).cast("bigint"), LOST: F.lit(False)}
        # With the open versions, a batch has at most twice its rows.
        floor = self.split_floor if self.split_floor is not None and 2 * load.rows > self.split_floor else None
        if not loads:
            return self._versions(events, floor).withColumns(stamp), 0
        touched = _folders(batch)
        opened = self._opened(loads, f"{OPEN} AND {_among(touched)}")
        asked = batch.groupBy(*self._key).agg(F.min(self.sequence).alias("_first"), F.max(F.col(self.sequence).isNull()).alias("_unordered"))
        opened = saved(null_safe_join(opened, asked, self._key, "inner"))
        behind = (F.col("_first") <= F.col(SEEN)) | F.col("_unordered")
        rebuilt_keys = opened.where(behind).select(*self._key)
        behind_in = _numbers(rebuilt_keys)
        late = rebuilt_keys.count() if behind_in else 0
        openers = opened.where(F.coalesce(~behind, F.lit(True))) if late else opened
        openers = openers.withColumnRenamed(DELETED, GONE).drop(START, END, OPEN, BATCH, LOST, "_first", "_unordered")
        ready = null_safe_join(events, rebuilt_keys, self._key, "left_anti") if late else events
        out = self._versions(ready.unionByName(openers, allowMissingColumns=True), floor).withColumns(stamp)
        if late:
            where = _among(behind_in)
            log = null_safe_join(self.store.read(self.log, where=where), rebuilt_keys, self._key, "left_semi")
            rebuilt = saved(self._versions(self._events(log), self.split_floor).withColumns(stamp))
            before = null_safe_join(self._closed(loads, f"NOT {OPEN} AND {where}"), rebuilt_keys, self._key, "left_semi")
            again = rebuilt.where(~F.col(OPEN)).select(*self._key, START)
            lost = null_safe_join(before, again, [*self._key, START], "left_anti").withColumns({**stamp, LOST: F.lit(True)})
            out = out.unionByName(rebuilt).unionByName(lost, allowMissingColumns=True)
        return out, late

    def _gone(self) -> Column:
        return holds(self.deletes) if self.deletes else F.lit(False)

    def _events(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({GONE: self._gone(), SEEN: F.col(self.sequence)})

    def _versions(self, events: DataFrame, split_floor: int | None) -> DataFrame:
        """History rows of ``events``.  The last sequence value seen rides along as a column that
        opens no version; so the open version carries the last one of its key."""
        hidden = {*self.keys, self.sequence, *self.except_columns, BUCKET, SEEN, GONE}
        tracked = self.tracked if self.tracked is not None else [c for c in events.columns if c not in hidden]
        out = scd2(
            events, self._key, self.sequence, self.ties, deletes=F.col(GONE),
            except_columns=[GONE, *self.except_columns], tracked=tracked, keep_deletes=True, split_floor=split_floor,
        )
        return out.withColumn(OPEN, F.col(END).isNull())

    # -- upkeep and reading ----------------------------------------------------------------

    def _over(self, base: list, later: list, where: str | None, same: list[str]) -> DataFrame:
        """Rows of the ``base`` loads but for those that ``later`` loads replace, and the newest of the later ones.
        The base is not shuffled when the later loads are small."""
        if not later:
            return self.store.read(self.name, base, where)
        newest = latest(self.store.read(self.name, later, where), same, [BATCH])
        if not base:
            return newest
        rest = null_safe_join(self.store.read(self.name, base, where), newest.select(*same), same, "left_anti")
        return rest.unionByName(newest, allowMissingColumns=True)

    def _opened(self, loads: list, where: str) -> DataFrame:
        return self._over(loads[:1], loads[1:], where, self._key)

    def _closed(self, loads: list, where: str) -> DataFrame:
        """Closed versions.  None is written twice before the first load with a late change."""
        first = next((i for i, load in enumerate(loads) if (load.counts or {}).get("late_keys")), len(loads))
        return self._over(loads[:first], loads[first:], where, [*self._key, START]).where(~F.col(LOST))

    def _current(self, loads: list, where: str | None = None) -> DataFrame:
        return self._over(loads[:1], loads[1:], where, self._key)

    def _rows(self, loads: list) -> DataFrame:
        """The table with its bookkeeping columns."""
        if self.scd_type == 1:
            return self._current(loads)
        return self._opened(loads, OPEN).unionByName(self._closed(loads, f"NOT {OPEN}"), allowMissingColumns=True)

    def fold(self) -> None:
        """Rewrites the many small loads of the log and of the table as one load each.

        Runs by itself after ``fold_after`` loads."""
        loads = self._loads()
        if len(loads) > 1:
            folders = [OPEN, BUCKET] if self.scd_type == 2 else [BUCKET]
            folded = f"{loads[-1].load_id}_folded"
            rows = self._rows(loads)
            rows = zorder(saved(rows), self.cluster_by, folders) if self.cluster_by else by_folder(rows, folders)
            facts = self.store.write(rows, self.name, folded, partition_by=folders)
            self._commit(folded, "full", 0, facts)
        logs = self.store.visible(self.log)
        if len(logs) > 1:
            rows = by_folder(self.store.read(self.log, logs), [BUCKET])
            self.store.put(rows, self.log, f"{logs[-1].load_id}_folded", "full", partition_by=[BUCKET])

    def table(self) -> DataFrame:
        """The table as readers see it: deletes hidden, bookkeeping columns gone."""
        return self._shown(self._rows(self._loads()))

    def current(self) -> DataFrame:
        """The open version of every key.  Folders of closed versions are not opened."""
        loads = self._loads()
        return self._shown(self._opened(loads, OPEN) if self.scd_type == 2 else self._current(loads))

    def changes(self, since=None, until=None) -> DataFrame:
        """The changes of the history between two values of the sequence, as ``history_feed`` gives them; of a type 1 table
        the log of versions is not kept, so it has none."""
        if self.scd_type != 2:
            raise ValueError(f"{self.name} keeps no history")
        return history_feed(self.table(), self.keys, since, until)

    def _shown(self, rows: DataFrame) -> DataFrame:
        return rows.where(~F.col(DELETED)).drop(DELETED, BUCKET, OPEN, SEEN, BATCH, LOST, *self.except_columns)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Runs the available part of ``stream`` through ``apply``."""
        return start_batches(stream, lambda batch, batch_id: self.apply(batch, batch_id), checkpoint)


def _numbers(rows: DataFrame) -> list[int]:
    """The bucket numbers in ``rows``: at most as many as there are buckets."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def _folders(rows: DataFrame) -> list[int]:
    """The bucket numbers of a stored load, from the names of its folders."""
    return sorted({int(path.split(f"{BUCKET}=")[1].split("/")[0]) for path in rows.inputFiles()})


def _among(numbers: list[int]) -> str:
    return f"{BUCKET} IN ({', '.join(map(str, numbers))})"
