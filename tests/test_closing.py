"""Late rows, append mode, bounded state, dead letters, row writer, offsets: with restarts and replays."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import BASE, line, write_file

from botsieve.functions.parse import corrupt_records, parse_events
from botsieve.operators.windows import window_features
from botsieve.params import WindowSpec
from botsieve.sources.events import kafka_records
from botsieve.streaming.closing import LateRowsJob, committed_watermark, run_closed_windows, run_distinct_categories
from botsieve.streaming.detector import detect, kafka_events_once, run_available_now, text_stream
from botsieve.streaming.row_writer import StagedRows, read_rows
from botsieve.streaming.tee import INCOMPLETE, TeeJob

SPEC = WindowSpec()
START = datetime(2018, 9, 27, 19, 20)


def minutes(n):
    return (START + timedelta(minutes=n)).replace(tzinfo=None)


def rows_of(df, *cols):
    got = df.select(*[F.col(c).cast("timestamp_ntz").alias(c.split(".")[-1]) if c.startswith("window.") else F.col(c) for c in cols]).collect()
    return sorted(map(tuple, got))


def forget_commit(checkpoint):
    """As if the driver was lost after the sink wrote and before the batch was committed."""
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    os.remove(f"{checkpoint}/commits/{last}")
    if os.path.exists(f"{checkpoint}/commits/.{last}.crc"):
        os.remove(f"{checkpoint}/commits/.{last}.crc")
    return last


def by_hand(rounds, spec_minutes=(10, 5)):
    """(window start, ip) -> [kept, late] of rounds of (second, ip)."""
    out, latest, mark = {}, None, None
    for rows in rounds:
        for t, ip in rows:
            for i in range(spec_minutes[0] // spec_minutes[1]):
                step = spec_minutes[1] * 60
                start = (BASE + t) // step * step - i * step
                is_late = mark is not None and start + spec_minutes[0] * 60 <= mark
                out.setdefault((start - BASE, ip), [0, 0])[is_late] += 1
        if rows:
            latest = max([latest or 0] + [BASE + t for t, _ in rows])
            mark = latest - 60
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_late_rows_against_brute_force(spark, scratch, seed):
    """Rounds of events in any order; kept and late together are all events of each window."""
    rng = random.Random(seed)
    rounds = [[(max(0, k * 400 + rng.randrange(-1500, 400)), rng.choice("ab")) for _ in range(rng.randrange(0, 9))] for k in range(7)]
    job = LateRowsJob(spark, f"{scratch}/feed", scratch, SPEC, 2)
    for k, rows in enumerate(rounds):
        write_file(job.feed, f"{k}.json", [line(t, ip) for t, ip in rows] or ["{}"])
        job.run()
        if k == 3:
            job.run()      # nothing new: nothing changes
    kept = {((r.window.start - datetime.fromtimestamp(BASE)).total_seconds(), r.ipAddress): r.amount for r in job.kept().collect()}
    late = {}
    for r in job.late().collect():
        key = ((r.window.start - datetime.fromtimestamp(BASE)).total_seconds(), r.ipAddress)
        late[key] = late.get(key, 0) + 1
    want = by_hand(rounds)
    assert kept == {k: n for k, (n, _) in want.items() if n} and late == {k: n for k, (_, n) in want.items() if n}
    assert late and committed_watermark(spark, f"{scratch}/windows") == datetime(1970, 1, 1) + timedelta(
        seconds=BASE + max(t for rows in rounds for t, _ in rows) - 60)


def test_late_rows_after_a_lost_run(spark, scratch):
    """The late rows were written, then the run was lost: the next one splits the input alike."""
    job = LateRowsJob(spark, f"{scratch}/feed", scratch, SPEC, 2)
    write_file(job.feed, "0.json", [line(0, "a"), line(2000, "a")])
    job.run()
    write_file(job.feed, "1.json", [line(5, "a"), line(1990, "a"), line(9000, "a")])
    aggregate, job.kept_run = job.lines, None
    calls = iter(range(9))
    job.lines = lambda: aggregate() if next(calls) == 0 else (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        job.run()
    assert job.late().count() == 2
    job.lines = aggregate
    job.run()
    assert job.late().count() == 2 and sum(r.amount for r in job.kept().collect()) + 2 == 2 * 5


def test_windows_close_once(spark, scratch):
    """Append mode: a window comes out when the watermark has passed it, complete, and once, also after a lost commit."""
    feed = f"{scratch}/feed"
    run = lambda: rows_of(run_closed_windows(spark, feed, scratch, SPEC, state_partitions=2), "window.start", "ipAddress", "amount")
    write_file(feed, "0.json", [line(10, "a"), line(20, "a")])
    assert run() == []
    write_file(feed, "1.json", [line(200, "a"), line(400, "b")])
    first = [(minutes(-5), "a", 3)]
    assert run() == first                       # 19:15-19:25 ended before 19:26:40 - 1 min
    forget_commit(f"{scratch}/closed-windows")
    assert run() == first and run() == first
    write_file(feed, "2.json", [line(250, "a"), line(3600, "c")])
    want = sorted(first + [(minutes(0), "a", 4), (minutes(0), "b", 1), (minutes(5), "b", 1)])
    assert run() == want
    forget_commit(f"{scratch}/closed-windows")
    assert run() == want


def test_distinct_categories_with_state_of_fixed_width(spark, scratch):
    """Equal to the set's size for closed windows; no state row holds an array."""
    rng = random.Random(4)
    feed, lines = f"{scratch}/feed", []
    for k in range(3):
        part = [line(k * 500 + rng.randrange(500), rng.choice("ab"), cat=rng.choice([1, 2, 3, None, "x"])) for _ in range(60)]
        part += part[:20]
        lines += part
        write_file(feed, f"{k}.json", part)
        got = run_distinct_categories(spark, feed, scratch, SPEC, 2)
    events = parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    mark = events.agg(F.max("unixTime")).first()[0] - timedelta(minutes=1)
    want = window_features(events, SPEC).where(F.col("window.end") <= F.lit(mark)).select("window", "ipAddress", "categories")
    assert rows_of(got, "window.start", "ipAddress", "categories") == rows_of(want, "window.start", "ipAddress", "categories") != []
    for operator in (0, 1):
        state = spark.read.format("statestore").option("operatorId", operator).load(f"{scratch}/distinct-categories")
        assert "array" not in state.select("key", "value").schema.simpleString()


def test_tee_keeps_every_line_once(spark, scratch):
    """Events, corrupt and incomplete lines are all lines; replays change nothing; the windows are those of the events."""
    lines = [line(0, "a"), line(1, "b", cat="x"), "{unix_time: 1}", "no object", "", '"{\\"unix_time\\": %d, \\"category_id\\": 2, \\"ip\\": \\"c\\", \\"type\\": \\"click\\"}",' % (BASE + 5),
             '{"unix_time": 5}', '{"ip": "z", }', "{}", line(400, "a")]
    job = TeeJob(spark, f"{scratch}/feed", scratch, SPEC, 2)
    write_file(job.feed, "0.json", lines[:6])
    job.run()
    write_file(job.feed, "1.json", lines[6:])
    job.run()

    def check():
        events = parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
        assert sorted(map(str, job.events().collect())) == sorted(map(str, events.collect()))
        bad = corrupt_records(spark.createDataFrame([(x,) for x in lines], "value string"))
        # a line with one unreadable field is still an event, and only that
        assert sorted(r.value for r in job.dead_letters().collect()) == sorted(r.value for r in bad.collect() if '"x"' not in r.value) != []
        assert job.dead_letters().count() + job.dead_letters(INCOMPLETE).count() + job.events().count() == len(lines)
        windows = window_features(events, SPEC, "set")
        assert rows_of(job.windows(), "window.start", "ipAddress", "amount", "categories") == rows_of(windows, "window.start", "ipAddress", "amount", "categories")
    check()
    forget_commit(f"{scratch}/split")
    job.run()
    check()
    forget_commit(f"{scratch}/windows")
    job.run()
    check()


SCHEMA = T.StructType([T.StructField("ipAddress", T.StringType()), T.StructField("end", T.TimestampType()), T.StructField("n", T.LongType())])


def test_staged_rows_of_one_partition(spark, tmp_path):
    """Attempts that fail or are killed leave nothing to read; a retry replaces; other epochs stay."""
    rows = [T.Row(ipAddress=f"ip{i}", end=datetime(2024, 1, 1, i % 24), n=i) for i in range(25)]

    def attempt(epoch, rows, fail=None, kill=False):
        writer = StagedRows(str(tmp_path / "out"), SCHEMA, rows=10)
        assert writer.open(3, epoch)
        for row in rows:
            writer.process(row)
        if kill:
            return
        if fail:
            with pytest.raises(ValueError):
                writer.close(fail)
        else:
            writer.close(None)
    attempt(0, rows[:15], kill=True)
    attempt(0, rows[:12], fail=ValueError("task lost"))
    attempt(0, [])
    assert not [n for n in os.listdir(tmp_path / "out" / "epoch=0") if n[0] not in "._"]
    attempt(0, rows)
    attempt(0, rows)
    attempt(1, rows[:2])
    got = read_rows(spark, str(tmp_path / "out"), SCHEMA)
    assert sorted((r.epoch, r.ipAddress, r.end, r.n) for r in got.collect()) == sorted([(0, *r) for r in rows] + [(1, *r) for r in rows[:2]])


def test_row_writer_in_a_stream(spark, scratch):
    """A task that fails half-way is retried, and a replayed epoch replaces its rows."""
    feed, mark = f"{scratch}/feed", f"{scratch}/failed"
    write_file(feed, "0.json", [line(i, f"ip{i % 20}") for i in range(200)])

    class Fragile(StagedRows):
        def close(self, error):
            super().close(error)
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise OSError("lost after the rename")
    updates = detect(text_stream(spark, feed), SPEC, thresholds=None).select("ipAddress", F.col("window.end").alias("end"), F.col("amount").alias("n"))

    def run(writer):
        q = updates.writeStream.outputMode("update").option("checkpointLocation", f"{scratch}/ckpt").foreach(writer).trigger(availableNow=True).start()
        q.awaitTermination()
    with pytest.raises(Exception):
        run(Fragile(f"{scratch}/out", SCHEMA, rows=3))     # local mode does not retry a task
    run(Fragile(f"{scratch}/out", SCHEMA, rows=3))
    want = sorted((f"ip{i}", end, 10) for i in range(20) for end in (minutes(5), minutes(10)))
    read = lambda: sorted((r.ipAddress, r.e, r.n) for r in read_rows(spark, f"{scratch}/out", SCHEMA).withColumn("e", F.col("end").cast("timestamp_ntz")).collect())
    assert read() == want
    forget_commit(f"{scratch}/ckpt")
    run(StagedRows(f"{scratch}/out", SCHEMA))
    assert read() == want


def test_replayed_offsets_are_dropped(spark, scratch):
    """Ranges sent again in any later batch, and records of one offset in two partitions."""
    events = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 5, "view", 1.0, '{"k": %d}' % i) for i in range(60)],
                                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    records = kafka_records(events).withColumn("offset", F.floor(F.col("offset") / 3))
    feed = f"{scratch}/feed"
    for sent in (records.where("offset < 10"), records.where("offset BETWEEN 5 AND 14"), records, records.unionAll(records)):
        sent.write.mode("append").parquet(feed)
        stream = kafka_events_once(spark.readStream.schema(records.schema).parquet(feed), "10 days")
        run_available_now(stream, f"{scratch}/ckpt", "append", path=f"{scratch}/out", state_partitions=2)
    told = records.select("partition", "offset").distinct().count()
    assert spark.read.parquet(f"{scratch}/out").count() == told
    assert json.loads(open(f"{scratch}/ckpt/metadata").read())["id"]
