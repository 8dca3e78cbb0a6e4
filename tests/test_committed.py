"""The commit-logged bot table: races, failures, expiry, compaction, bounded files."""

import json
import os
import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from botsieve.operators.committed import CommittedBots, CommitConflict
from botsieve.params import DAILY, Thresholds
from botsieve.plans.jobs import DetectorJob
from botsieve.sources.shared_files import SharedFiles
from botsieve.streaming.detector import committed_sink

DAY = datetime(2024, 1, 1)


def ips(spark, names, end=DAY):
    return spark.createDataFrame([(n, end) for n in names], "ipAddress string, end timestamp")


def rows(df):
    found = sorted((r.ipAddress, r.created_at.replace(tzinfo=None)) for r in df.collect())
    return found


def test_create_if_absent_is_whole_or_nothing(spark, scratch):
    files, path = SharedFiles(spark), f"{scratch}/log/1.json"
    done = []
    threads = [threading.Thread(target=lambda k=k: done.append((files.create(path, f"text {k}" * 1000), k))) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winner = [k for won, k in done if won]
    assert len(winner) == 1 and files.read(path) == f"text {winner[0]}" * 1000
    assert list(files.names(f"{scratch}/log")) == ["1.json"] and files.names(f"{scratch}/none") == {}


def test_interleaved_merges_list_each_address_once(spark, scratch):
    """B reads, A commits, B loses and merges anew: the first commit keeps its rows."""
    a, b = CommittedBots(spark, scratch, buckets=4), CommittedBots(spark, scratch, buckets=4)
    added = []
    b.before_commit = [lambda: added.append(a.merge(ips(spark, "wxyz"), created_at=DAY))]
    added.append(b.merge(ips(spark, "yzuv"), created_at=DAY + timedelta(days=1)))
    assert added == [4, 2]
    assert rows(a.read()) == [(n, DAY + timedelta(days=n in "uv")) for n in "uvwxyz"]
    assert a.versions() == [0, 1]
    # what the losing attempt wrote is on disk, but in no manifest
    assert rows(a.read(version=0)) == [(n, DAY) for n in "wxyz"]


def test_parallel_merges(spark, scratch):
    """Four writers at once, two batches each, all overlapping: one row per address, and every address."""
    def work(k):
        table = CommittedBots(spark, scratch, buckets=4)
        for batch in (range(k * 5, k * 5 + 15), range(20, 30)):
            table.merge(ips(spark, map(str, batch)), created_at=DAY + timedelta(hours=k))
    threads = [threading.Thread(target=work, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(int(n) for n, _ in rows(CommittedBots(spark, scratch).read())) == list(range(30))


def test_merges_of_other_buckets_do_not_conflict(spark, scratch):
    """The loser only writes a later manifest: nothing is merged twice."""
    a, b = CommittedBots(spark, scratch, buckets=64), CommittedBots(spark, scratch, buckets=64)
    bucket = {r[0]: r[1] for r in spark.range(40).select(F.col("id").cast("string").alias("n")).select("n", a.bucket_of(F.col("n"), 64)).collect()}
    one = "1"
    other = next(n for n in bucket if bucket[n] != bucket[one])
    b.before_commit = [lambda: a.merge(ips(spark, [one]), created_at=DAY)]
    attempts = []
    write = b._write
    b._write = lambda *args: attempts.append(1) or write(*args)
    assert b.merge(ips(spark, [other]), created_at=DAY) == 1
    assert len(attempts) == 1 and {n for n, _ in rows(a.read())} == {one, other}


def test_failed_merge_leaves_nothing_visible(spark, scratch):
    table = CommittedBots(spark, scratch)
    table.merge(ips(spark, "a"), created_at=DAY)

    def fail():
        raise OSError("driver lost")
    table.before_commit = [fail]
    with pytest.raises(OSError):
        table.merge(ips(spark, "bc"), created_at=DAY)
    assert rows(CommittedBots(spark, scratch).read()) == [("a", DAY)]
    assert CommittedBots(spark, scratch).merge(ips(spark, "bc"), created_at=DAY) == 2
    assert table.vacuum(min_age_hours=24) == 0 and table.vacuum(min_age_hours=0) >= 1   # the failed attempt's folder goes
    assert [n for n, _ in rows(table.read())] == ["a", "b", "c"]


def test_a_writer_that_always_loses_gives_up(spark, scratch, monkeypatch):
    from botsieve.operators import committed
    monkeypatch.setattr(committed, "ATTEMPTS", 2)
    table, other = CommittedBots(spark, scratch, buckets=1), CommittedBots(spark, scratch, buckets=1)
    counter = iter(range(100))
    table._commit = lambda *args: not other.merge(ips(spark, [f"o{next(counter)}"]))
    with pytest.raises(CommitConflict):
        table.merge(ips(spark, "a"))


def test_merge_reads_only_touched_buckets(spark, scratch):
    """Folders of other buckets can be away: the merge never opens them."""
    table = CommittedBots(spark, scratch, buckets=8)
    table.merge(ips(spark, [str(i) for i in range(50)]), created_at=DAY)
    bucket = spark.createDataFrame([("7",)], "n string").select(table.bucket_of(F.col("n"), 8)).first()[0]
    away = [p for p in table.snapshot().paths() if not p.endswith(f"bucket={bucket}")]
    for p in away:
        table.files.delete(f"{scratch}/data/{p}")
    assert table.merge(ips(spark, ["7"]), created_at=DAY + timedelta(days=1)) == 0


def test_expiry_relisting_and_compaction(spark, scratch):
    """Against a dictionary: random merges over 12 days with a TTL of 2 days."""
    rng, table, want, everyone = random.Random(3), CommittedBots(spark, scratch, buckets=3, deltas=2), {}, [f"ip{i}" for i in range(12)]
    for day in range(12):
        now = DAY + timedelta(days=day)
        batch = rng.sample(everyone, 4)
        want = {n: t for n, t in want.items() if t > now - timedelta(days=2)}
        fresh = [n for n in batch if n not in want]
        want.update(dict.fromkeys(fresh, now))
        assert table.merge(ips(spark, batch), created_at=now, as_of=now, ttl_hours=48) == len(fresh)
        assert rows(table.read(now, 48)) == sorted(want.items())
        assert all(len(entries) <= 2 for entries in table.snapshot().folders.values())
        table.vacuum(keep=1, min_age_hours=0)
        stored = [f for top, _, names in os.walk(f"{scratch}/data") for f in names if f.endswith(".parquet")]
        assert len(stored) <= 3 * 2 * 2 and len(table.versions()) == 1   # files stay bounded
    later = DAY + timedelta(days=40)
    table.merge(ips(spark, ["new"]), created_at=later, as_of=later, ttl_hours=48)
    assert sum(len(e) for e in table.snapshot().folders.values()) == 1    # expired folders left unread


def test_replayed_batch_is_not_merged_again(spark, scratch):
    """Also where its entries have expired since: the commit holds the batch."""
    sink = committed_sink(scratch, "q", created_at=DAY, as_of=DAY, ttl_hours=24)
    sink(ips(spark, "ab"), 0)
    late = committed_sink(scratch, "q", created_at=DAY + timedelta(days=9), as_of=DAY + timedelta(days=9), ttl_hours=24)
    late(ips(spark, "ab"), 0)
    table = CommittedBots(spark, scratch)
    assert rows(table.read()) == [("a", DAY), ("b", DAY)] and table.versions() == [0]
    late(ips(spark, []), 1)
    assert json.loads(table.files.read(table._manifest(1)))["batches"] == {"q": 1}


def test_empty_table_and_null_addresses(spark, scratch):
    table = CommittedBots(spark, scratch)
    assert table.read().count() == 0 and table.vacuum() == 0
    assert table.merge(ips(spark, [None])) == 0 and table.merge(ips(spark, [])) == 0
    assert table.merge(ips(spark, [None, "", "é"]), created_at=DAY) == 2 and rows(table.read()) == [("", DAY), ("é", DAY)]


def test_detector_job_keeps_a_bounded_table(spark, scratch):
    """The tick loop on the commit-logged table: the list feeds back, and ticks
    without new bots add no data files."""
    def feed(i, lines):
        os.makedirs(f"{scratch}/feed", exist_ok=True)
        with open(f"{scratch}/feed/.{i}", "w") as f:
            f.writelines(json.dumps({"unix_time": 1_700_000_000 + t, "category_id": 1, "ip": ip, "type": "view"}) + ",\n" for ip, t in lines)
        os.rename(f"{scratch}/feed/.{i}", f"{scratch}/feed/{i}.json")
    job = DetectorJob(spark, f"{scratch}/bots", f"{scratch}/ckpt", source_dir=f"{scratch}/feed", spec=DAILY,
                      thresholds=Thresholds(max_amount=2, max_rate=1e9, max_categories=10 ** 9), list_format="commits")
    for i in range(4):
        feed(i, [("a", i), ("b", i), ("b", i), ("b", i)] if i == 0 else [("a", i), ("b", i)])
        job.run(ticks=1)
    table = CommittedBots(spark, f"{scratch}/bots")
    assert {n for n, _ in rows(table.read())} == {"a", "b"}
    assert sum(len(e) for e in table.snapshot().folders.values()) == 2
