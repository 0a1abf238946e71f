"""Read-model tables on plain Parquet.

A table's rows lie in runs, ``runs/<name>/.../_bucket=B``: a write makes one run of each bucket it touches, the bucket being a hash of
the key. The manifest names the runs that count; see ``manifest``.

*Upsert table.* The row of the last write wins. *Event log.* The first arrival of an id wins; runs
are also split by day, and each has a key filter, so that a batch reads only runs that may hold one of its ids.

*Replays.* A batch delivered again replaces its own runs. If upkeep has merged or pruned these in the meantime, it is applied
on top: nothing of it is lost, whatever was pruned. Batches before the last committed one are already in the table and change nothing.

*Compaction.* Each bucket's runs are kept so that from new to old each is at least twice as long as all newer ones together;
a new run that breaks this is merged with those that are too short. So a bucket of n rows has at most some log2(n) runs, a row
is rewritten as often, and buckets without traffic are left alone. Writers compact when a bucket reaches ``MAX_RUNS``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readmill import files
from readmill.operators import retention
from readmill.operators.coalesce import ARRIVAL, latest_per_key
from readmill.operators.merge import append_new
from readmill.sources import key_filter, manifest
from readmill.sources.manifest import Manifest, Run

BUCKETS = 16
#: Buckets of each day of an event log.
DAY_BUCKETS = 4
MAX_RUNS = 12
#: Seconds before files that no manifest names are taken for left-overs.
GRACE_S = 3_600
_WRITE = "_write"
_BUCKET = "_bucket"
_DAY = "event_date"


def _overwrite_partitions(rows: DataFrame, path: str, *by: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


@dataclass(frozen=True)
class _Table:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType

    def _load(self) -> Manifest:
        return manifest.load(self.spark, self.path)

    def committed(self) -> int | None:
        """The last batch that is in the table."""
        return self._load().batch

    def runs(self) -> list[Run]:
        return list(self._load().runs)

    def _stored(self) -> T.StructType:
        fields = [f for f in self.schema.fields if f.name not in ARRIVAL]
        return T.StructType([*fields, T.StructField(_WRITE, T.LongType())])

    def _rows(self, runs: Iterable[Run]) -> DataFrame:
        """All rows of the runs, with the number of their write."""
        paths = sorted({f"{self.path}/{r.path}" for r in runs})
        if not paths:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*paths)

    def _buckets(self) -> int:
        return BUCKETS

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self._buckets())).cast("int")

    def _write(self, rows: DataFrame, *by: str) -> str:
        """Write rows as new runs, one file or so of each; returns their folder.

        The number of tasks is given, as small batches would otherwise be put together into one that opens file after file.
        """
        folder = f"runs/{uuid.uuid4().hex}"
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.withColumn(_BUCKET, self._bucket()).repartition(tasks, *by, _BUCKET)
        placed.write.partitionBy(*by, _BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def _counted(self, folder: str, *by: T.StructField) -> DataFrame:
        schema = T.StructType([*self._stored().fields, *by, T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _commit_batch(self, before: Manifest, made: list[Run], batch_id: int) -> None:
        def change(current: Manifest) -> Manifest:
            if current.writes != before.writes:
                raise RuntimeError(f"{self.path}: a second stream writes to this table")
            kept = tuple(r for r in current.runs if not r.only(batch_id))
            return replace(current, writes=before.writes + 1, batch=batch_id, runs=(*kept, *made))

        after = manifest.commit(self.spark, self.path, change)
        if max(map(len, _by_place(after.runs).values()), default=0) >= MAX_RUNS:
            self.compact()

    def _too_short(self, runs: Iterable[Run]) -> list[list[Run]]:
        """The runs to be merged, a list for each bucket that has any."""
        groups = []
        for place in _by_place(runs).values():
            group = [place[-1]]
            for run in reversed(place[:-1]):
                if run.rows >= 2 * sum(r.rows for r in group):
                    break
                group.append(run)
            if len(group) > 1:
                groups.append(group)
        return groups

    def compact(self) -> int:
        """Merge runs that are too short for their place; returns how many went."""
        raise NotImplementedError

    def vacuum(self, grace_s: float = GRACE_S) -> list[str]:
        """Remove files that the manifest does not name and that are older than ``grace_s``; returns them."""
        limit = time.time() - grace_s
        current = self._load().runs
        used = {r.path for r in current} | {r.filter for r in current if r.filter}
        folders = {"/".join(p.split("/")[:2]) for p in used}
        gone = []
        for top in ("runs", "filters"):
            for name in files.children(self.spark, f"{self.path}/{top}"):
                folder = f"{top}/{name}"
                if folder in folders or files.modified(self.spark, f"{self.path}/{folder}") > limit:
                    continue
                files.remove(self.spark, f"{self.path}/{folder}")
                gone.append(folder)
        # Of folders that are still in use, buckets that were merged away.
        for folder in sorted(f for f in folders if f.startswith("runs/")):
            for path in self._parts(folder):
                if path not in used and files.modified(self.spark, f"{self.path}/{path}") <= limit:
                    files.remove(self.spark, f"{self.path}/{path}")
                    gone.append(path)
        return gone

    def _parts(self, folder: str) -> list[str]:
        names = files.children(self.spark, f"{self.path}/{folder}")
        return [f"{folder}/{n}" for n in names if n.startswith(f"{_BUCKET}=")]


def _by_place(runs: Iterable[Run]) -> dict[tuple, list[Run]]:
    """The runs of each day and bucket, old ones first."""
    places: dict[tuple, list[Run]] = {}
    for run in runs:
        places.setdefault((run.day, run.bucket), []).append(run)
    # Runs are listed in the order of their commits; a merged one takes the place of its newest batch.
    return {p: sorted(rs, key=lambda r: r.last_batch) for p, rs in places.items()}


@dataclass(frozen=True)
class UpsertTable(_Table):
    def write_batch(self, rows: DataFrame, batch_id: int) -> bool:
        """Rows with one row per key plus ``partition`` and ``offset``; False, and nothing is done, for a batch before the last one."""
        before = self._load()
        if before.batch is not None and batch_id < before.batch:
            return False
        stamped = rows.drop(*ARRIVAL).withColumn(_WRITE, F.lit(before.writes + 1).cast("bigint"))
        self._commit_batch(before, self._made(self._write(stamped), batch_id, batch_id), batch_id)
        return True

    def _made(self, folder: str, first: int, last: int) -> list[Run]:
        counts = self._counted(folder).groupBy(_BUCKET).count().collect()
        return [Run(f"{folder}/{_BUCKET}={b}", b, n, first, last) for b, n in sorted(map(tuple, counts))]

    def _state(self, runs: Iterable[Run]) -> DataFrame:
        """The last row of each key; buckets of one run have only those."""
        places = _by_place(runs).values()
        alone = self._rows(p[0] for p in places if len(p) == 1)
        several = [r for p in places if len(p) > 1 for r in p]
        if not several:
            return alone
        return alone.unionByName(latest_per_key(self._rows(several), list(self.keys), [_WRITE]))

    def read(self) -> DataFrame:
        return self._state(self._load().runs).drop(_WRITE)

    def _rewrite(self, groups: list[list[Run]], state: DataFrame) -> bool:
        old = [r for g in groups for r in g]
        folder = self._write(state)
        spans = {g[0].bucket: (min(r.first_batch for r in g), max(r.last_batch for r in g)) for g in groups}
        made = [replace(r, first_batch=spans[r.bucket][0], last_batch=spans[r.bucket][1]) for r in self._made(folder, 0, 0)]
        return manifest.replace_runs(self.spark, self.path, old, made)

    def compact(self) -> int:
        groups = self._too_short(self._load().runs)
        if not groups:
            return 0
        old = [r for g in groups for r in g]
        merged = latest_per_key(self._rows(old), list(self.keys), [_WRITE])
        return len(old) if self._rewrite(groups, merged) else 0

    def merge(self, through: int, as_of: datetime | None = None, ttl_hours: int | None = None) -> None:
        """One run of each bucket for all batches up to ``through``, without rows past their TTL."""
        groups = list(_by_place(r for r in self._load().runs if r.last_batch <= through).values())
        state = self._state(r for g in groups for r in g)
        if as_of is not None:
            state = retention.prune(state, "updated_at", ttl_hours, F.lit(as_of))
        if groups:
            self._rewrite(groups, state)

    def prune(self, as_of: datetime, ttl_hours: int | None) -> int:
        """Rewrite the buckets that hold rows past their TTL without them; returns the number of such rows."""
        if not ttl_hours:
            return 0
        runs = self._load().runs
        old = retention.expired("updated_at", ttl_hours, F.lit(as_of))
        counts = self._state(runs).where(old).groupBy(self._bucket().alias("b")).count().collect()
        gone = dict(map(tuple, counts))
        groups = [g for g in _by_place(runs).values() if g[0].bucket in gone]
        if not groups:
            return 0
        state = self._state(r for g in groups for r in g)
        kept = retention.prune(state, "updated_at", ttl_hours, F.lit(as_of))
        # If the stream has replaced one of these runs meanwhile, the next run of upkeep prunes.
        return sum(gone.values()) if self._rewrite(groups, kept) else 0


@dataclass(frozen=True)
class EventLog(_Table):
    time_column: str = "time"

    def _buckets(self) -> int:
        return DAY_BUCKETS

    def _day(self) -> Column:
        return F.date_add(
            F.lit(date(1970, 1, 1)),
            F.floor(F.unix_micros(self.time_column) / F.lit(86_400_000_000)).cast("int"),
        )

    def write_batch(self, rows: DataFrame, batch_id: int) -> bool:
        """Rows with one row per key plus ``partition`` and ``offset``; False, and nothing is done, for a batch before the last one."""
        before = self._load()
        if before.batch is not None and batch_id < before.batch:
            return False
        earlier = self.may_hold(rows, [r for r in before.runs if not r.only(batch_id)])
        new = append_new(self._rows(earlier), rows.drop(*ARRIVAL), self.keys)
        stamped = new.withColumn(_WRITE, F.lit(before.writes + 1).cast("bigint"))
        self._commit_batch(before, self._placed(stamped, batch_id, batch_id), batch_id)
        return True

    def may_hold(self, rows: DataFrame, runs: list[Run]) -> list[Run]:
        """Those of the runs whose key filter does not rule out every key of ``rows``."""
        hits = key_filter.hits(
            rows.select(F.xxhash64(*self.keys).alias("key"), self._bucket().alias(_BUCKET)),
            [(i, r.day, r.bucket, r.filter, r.parts) for i, r in enumerate(runs)],
            self.path,
        )
        return [runs[i] for i in hits]

    def _placed(self, rows: DataFrame, first: int, last: int) -> list[Run]:
        """Write rows as runs of their days and buckets, with their key filters."""
        folder = self._write(rows.withColumn(_DAY, self._day()), _DAY)
        written = self._counted(folder, T.StructField(_DAY, T.DateType()))
        counts = written.groupBy(_DAY, _BUCKET).count().collect()
        filters = f"filters/{folder.removeprefix('runs/')}"
        made = []
        for day, bucket, n in sorted(map(tuple, counts), key=lambda c: (c[0] is not None, c)):
            name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
            path = f"{folder}/{_DAY}={name}/{_BUCKET}={bucket}"
            made.append(Run(path, bucket, n, first, last, day and day.isoformat(), filters, key_filter.parts(n)))
        keys = written.select(_DAY, _BUCKET, F.xxhash64(*self.keys).alias("key"))
        sizes = [(r.day, r.bucket, r.parts) for r in made]
        key_filter.write(keys, sizes, self.path, filters)
        return made

    def _parts(self, folder: str) -> list[str]:
        days = [f"{folder}/{n}" for n in files.children(self.spark, f"{self.path}/{folder}") if n.startswith(f"{_DAY}=")]
        return [path for day in days for path in super(EventLog, self)._parts(day)]

    def compact(self) -> int:
        groups = self._too_short(self._load().runs)
        old = [r for g in groups for r in g]
        if not old:
            return 0
        made = self._placed(self._rows(old), 0, 0)
        spans = {(g[0].day, g[0].bucket): (min(r.first_batch for r in g), max(r.last_batch for r in g)) for g in groups}
        made = [replace(r, first_batch=spans[r.day, r.bucket][0], last_batch=spans[r.day, r.bucket][1]) for r in made]
        return len(old) if manifest.replace_runs(self.spark, self.path, old, made) else 0

    def read(self, as_of: datetime | None = None, hours: int | None = None) -> DataFrame:
        """The log, optionally cut at the retention limit; whole days are not scanned."""
        runs = self._load().runs
        if as_of is None or not hours:
            return self._rows(runs).drop(_WRITE)
        border = _border(as_of, hours)
        log = self._rows(r for r in runs if r.day is None or r.day >= border)
        return retention.prune(log, self.time_column, hours, F.lit(as_of)).drop(_WRITE)

    def prune(self, as_of: datetime, hours: int | None) -> int:
        """Remove every row past the limit; returns their number.

        Whole days leave the manifest unread. Only the day in which the limit lies is rewritten, in the buckets that
        hold such rows.
        """
        if not hours:
            return 0
        runs, border = self._load().runs, _border(as_of, hours)
        whole = [r for r in runs if r.day is not None and r.day < border]
        split = [r for r in runs if r.day == border]
        old = retention.expired(self.time_column, hours, F.lit(as_of))
        counts = self._rows(split).where(old).groupBy(self._bucket().alias("b")).count().collect() if split else []
        gone = dict(map(tuple, counts))
        touched = [r for r in split if r.bucket in gone]
        if not whole and not touched:
            return 0
        made = []
        if touched:
            kept = retention.prune(self._rows(touched), self.time_column, hours, F.lit(as_of))
            # One run for each bucket, as after a compaction.
            made = self._placed(kept, 0, 0)
            spans = {b: [r for r in touched if r.bucket == b] for b in gone}
            made = [
                replace(r, first_batch=min(o.first_batch for o in spans[r.bucket]), last_batch=max(o.last_batch for o in spans[r.bucket]))
                for r in made
            ]
        done = manifest.replace_runs(self.spark, self.path, [*whole, *touched], made)
        return sum(r.rows for r in whole) + sum(gone.values()) if done else 0


def _border(as_of: datetime, hours: int) -> str:
    """The day in which the limit lies."""
    moment = as_of - timedelta(hours=hours)
    return (moment if moment.tzinfo is None else moment.astimezone(timezone.utc)).date().isoformat()
