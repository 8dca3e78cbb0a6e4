"""The bot table as a commit-logged, bucketed table (K1-K4).

    table/data/<commit id>/bucket=<b>/...    Parquet, written by one merge
    table/log/<version>.json                 manifest: the folders of each bucket

An address lies in the bucket of its hash. A manifest lists, per bucket, a base
and the deltas added since, each with the newest ``created_at`` in it; what no
manifest lists is not part of the table. A merge

1. reads the newest manifest and the buckets that its addresses fall in,
2. writes the rows that are new, put-if-absent, to a folder of its own,
3. commits by creating the next manifest, which only one writer can do.

A merge that loses the race looks at what the winners touched: with no bucket in
common it only writes a later manifest, otherwise it merges anew against them.
So each address is listed once however many jobs feed the table, a merge that
fails at any point leaves nothing visible, and readers always see one version.

Expiry is part of a commit. A folder whose newest row has expired leaves the
manifest unread. A touched bucket of more than ``deltas`` folders is rewritten
as a new base of its live rows. ``vacuum`` deletes what no kept version lists.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botsieve.operators.blocklist import BOT_SCHEMA, active, empty_bots, flagged_ips, new_entries, one_row_per_ip
from botsieve.params import BLOCK_TTL_HOURS, BOT_KEY
from botsieve.sources.shared_files import SharedFiles

BUCKETS, DELTAS, ATTEMPTS = 16, 4, 20
STORED = T.StructType([*BOT_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])
EPOCH = datetime(1970, 1, 1)


class CommitConflict(RuntimeError):
    """Other writers were first ``ATTEMPTS`` times in a row."""


@dataclass
class Snapshot:
    """One version: bucket -> [[folder, newest created_at in microseconds], ...],
    base first; ``batches``: the last batch each stream has merged."""

    version: int = -1
    buckets: int = BUCKETS
    folders: dict[int, list[list]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    touched: list[int] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"buckets": self.buckets, "folders": self.folders, "batches": self.batches, "touched": self.touched})

    @classmethod
    def from_json(cls, version: int, text: str) -> Snapshot:
        read = json.loads(text)
        return cls(version, read["buckets"], {int(b): f for b, f in read["folders"].items()}, read["batches"], read["touched"])

    def paths(self, buckets=None) -> list[str]:
        return [f"{folder}/bucket={b}" for b, entries in sorted(self.folders.items()) if buckets is None or b in buckets
                for folder, _ in entries]


def micros(when: datetime) -> int:
    """Microseconds since the epoch; a datetime without a zone is UTC."""
    if when.tzinfo is not None:
        when = when.astimezone(timezone.utc).replace(tzinfo=None)
    return (when - EPOCH) // timedelta(microseconds=1)


class CommittedBots:
    """A bot table at ``path`` that several jobs may merge into and read."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, deltas: int = DELTAS):
        self.spark, self.path, self.buckets, self.deltas = spark, path.rstrip("/"), buckets, deltas
        self.files = SharedFiles(spark)
        self.before_commit: list[Callable[[], object]] = []   # run once each, to stage races

    # ---------------------------------------------------------------- reads --

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/log") if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the one asked for; an empty one at first."""
        if version is None:
            version = max(self.versions(), default=-1)
        if version < 0:
            return Snapshot(buckets=self.buckets)
        return Snapshot.from_json(version, self.files.read(self._manifest(version)))

    def read(self, as_of: datetime | None = None, ttl_hours: int = BLOCK_TTL_HOURS, version: int | None = None) -> DataFrame:
        """The rows of a version; with ``as_of``, those alive then."""
        return active(self._rows(self.snapshot(version)), as_of, ttl_hours).select(*BOT_SCHEMA.fieldNames())

    def _rows(self, snap: Snapshot, buckets=None) -> DataFrame:
        paths = [f"{self.path}/data/{p}" for p in snap.paths(buckets)]
        return self.spark.read.schema(BOT_SCHEMA).parquet(*paths) if paths else empty_bots(self.spark)

    def _manifest(self, version: int) -> str:
        return f"{self.path}/log/{version:012d}.json"

    def bucket_of(self, address: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(address), F.lit(buckets)).cast("int")

    # --------------------------------------------------------------- writes --

    def merge(self, flagged: DataFrame, created_at: datetime | None = None, as_of: datetime | None = None,
              ttl_hours: int = BLOCK_TTL_HOURS, batch: tuple[str, int] | None = None) -> int:
        """Flagged addresses that are not (actively) listed, put-if-absent, as
        one commit; returns how many were added. ``batch`` (stream, batch id): a
        batch that the table already holds is not merged again."""
        created_at = created_at or datetime.now(timezone.utc)
        ips = flagged_ips(flagged) if "window" in flagged.columns else flagged
        ips = one_row_per_ip(ips.where(F.col(BOT_KEY).isNotNull())).persist()
        try:
            for _ in range(ATTEMPTS):
                base = self.snapshot()
                if batch and base.batches.get(batch[0], -1) >= batch[1]:
                    return 0
                touched, added, written = self._write(ips, base, created_at, as_of, ttl_hours)
                if not touched and not batch:
                    return 0
                if self._commit(base, touched, written, as_of, ttl_hours, batch):
                    return added
            raise CommitConflict(f"{self.path}: {ATTEMPTS} attempts")
        finally:
            ips.unpersist()

    def _write(self, ips: DataFrame, base: Snapshot, created_at, as_of, ttl_hours):
        """New rows, and the live rows of buckets due for a rewrite, to a folder
        of this attempt. Gives (buckets read, rows added, bucket -> (folder,
        newest created_at, whether it replaces the others))."""
        bucket = self.bucket_of(F.col(BOT_KEY), base.buckets)
        touched = sorted(r[0] for r in ips.select(bucket).distinct().collect())   # at most the bucket count
        if not touched:
            return [], 0, {}
        due = [b for b in touched if len(base.folders.get(b, [])) >= self.deltas]
        fresh = new_entries(ips, self._rows(base, set(touched)), created_at, as_of, ttl_hours).withColumn("old", F.lit(False))
        if due:
            fresh = fresh.unionByName(active(self._rows(base, set(due)), as_of, ttl_hours).withColumn("old", F.lit(True)))
        folder = uuid.uuid4().hex
        target = f"{self.path}/data/{folder}"
        rows = fresh.withColumn("bucket", bucket)
        rows.repartition("bucket").write.partitionBy("bucket").parquet(target)
        kept = self.spark.read.schema(T.StructType([*STORED.fields, T.StructField("old", T.BooleanType())])).parquet(target)
        found = kept.groupBy("bucket").agg(F.count_if(~F.col("old")).alias("added"), F.unix_micros(F.max("created_at")).alias("newest")).collect()
        written = {r.bucket: (folder, r.newest, r.bucket in due) for r in found}
        for b in due:   # nothing live is left of a bucket
            written.setdefault(b, (None, 0, True))
        return touched, sum(r.added for r in found), written

    def _commit(self, base: Snapshot, touched: list[int], written: dict, as_of, ttl_hours, batch) -> bool:
        """Create the manifest after ``base``; if others did, after theirs, as
        long as they touched none of the buckets that this merge has read."""
        while self.before_commit:
            self.before_commit.pop(0)()
        while True:
            folders = {b: list(entries) for b, entries in base.folders.items()}
            for b, (folder, newest, whole) in written.items():
                kept = [] if whole else folders.get(b, [])
                folders[b] = kept + ([[folder, newest]] if folder else [])
            if as_of is not None:
                cutoff = micros(as_of) - ttl_hours * 3_600_000_000
                folders = {b: [e for e in entries if e[1] > cutoff] for b, entries in folders.items()}
            batches = base.batches | ({batch[0]: batch[1]} if batch else {})
            made = Snapshot(base.version + 1, base.buckets, {b: e for b, e in folders.items() if e}, batches, touched)
            if self.files.create(self._manifest(made.version), made.to_json()):
                return True
            for version in range(made.version, max(self.versions()) + 1):
                base = self.snapshot(version)
                if set(base.touched) & set(touched) or batch and base.batches.get(batch[0], -1) >= batch[1]:
                    return False

    def vacuum(self, keep: int = 2, min_age_hours: float = 24) -> int:
        """Delete manifests but the last ``keep`` and those younger than
        ``min_age_hours``, and folders of that age that no manifest left lists;
        returns how many went. A folder of a merge that has not committed yet is
        in no manifest either, and a reader may hold a version that is no longer
        the newest: let the age be longer than any merge or reader takes."""
        before = time.time() * 1000 - min_age_hours * 3_600_000
        changed = {int(n[:-5]): t for n, t in self.files.names(f"{self.path}/log").items() if n.endswith(".json") and n[:-5].isdigit()}
        versions = sorted(changed)
        old = [v for v in versions[:-keep] if changed[v] <= before]
        listed = {p for v in versions if v not in old for p in self.snapshot(v).paths()}
        gone = 0
        for folder, last in self.files.names(f"{self.path}/data").items():
            if last > before:
                continue
            parts = [f"{folder}/{p}" for p in self.files.names(f"{self.path}/data/{folder}")]
            live = [p for p in parts if p in listed]
            for p in [p for p in parts if "/bucket=" in p and p not in listed] if live else [folder]:
                self.files.delete(f"{self.path}/data/{p}")
                gone += 1
        for version in old:
            self.files.delete(self._manifest(version))
        return gone
