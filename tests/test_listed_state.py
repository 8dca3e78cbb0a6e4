"""Addresses listed as keyed state: against a sequential brute force."""

import random
from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_streaming import BASE, line, write_file

from botsieve.functions.parse import parse_events, with_event_time
from botsieve.params import Thresholds, WindowSpec
from botsieve.plans import catalog
from botsieve.streaming.detector import run_available_now, session_conf, text_stream
from botsieve.streaming import listed_state
from botsieve.streaming.listed_state import RECORD, ListedAddresses, gather, listings

SPEC, TTL = WindowSpec(), 0.25      # 10 minutes by 5; entries live 15 minutes


def by_hand(events, th):
    """One event after the other; every window's whole history is kept."""
    out, until, windows = [], {}, {}
    for t, kind, cat, ip in sorted(events, key=lambda e: (e[0], e[1], e[2] is not None, e[2] or 0)):
        found = []
        for start in (t // 300 * 300, t // 300 * 300 - 300):
            if start < until.get(ip, -1e18):
                continue
            seen = windows.setdefault((ip, start), [])
            seen.append((kind, cat))
            clicks, views = (sum(k == x for k, _ in seen) for x in ("click", "view"))
            if len(seen) > th.max_amount or views and clicks / views > th.max_rate or len({c for _, c in seen if c is not None}) > th.max_categories:
                found.append(start + 600)
        if found:
            out.append((ip, max(found), t))
            until[ip] = t + TTL * 3600
    return sorted(out)


@pytest.mark.parametrize("seed, th", [(1, Thresholds(4, 2.0, 3)), (2, Thresholds(10 ** 6, 1.5, 4)), (3, Thresholds(3, 1e9, 10 ** 6))])
def test_against_sequential_brute_force(spark, scratch, seed, th):
    rng = random.Random(seed)
    rounds = [[(k * 2000 + rng.randrange(2000), rng.choice(["click", "click", "view", "buy"]), rng.choice([None, 1, 2, 3, 4, 5, 6]),
                rng.choice("aaabc")) for _ in range(70)] for k in range(4)]
    for k, rows in enumerate(rounds):
        write_file(f"{scratch}/feed", f"{k}.json", [line(t, ip, kind, cat) for t, kind, cat, ip in rows])
        events = with_event_time(parse_events(text_stream(spark, f"{scratch}/feed")))
        run_available_now(listings(events, SPEC, th, TTL), f"{scratch}/ckpt", "append", path=f"{scratch}/out", state_partitions=2)
    got = spark.read.parquet(f"{scratch}/out").select("ipAddress", F.unix_seconds("end"), F.unix_seconds("listed_at")).collect()
    want = by_hand([(BASE + t, kind, cat, ip) for rows in rounds for t, kind, cat, ip in rows], th)
    assert sorted(map(tuple, got)) == want and len(want) > 5


def test_a_hot_address_leaves_little_state(spark, scratch):
    """50,000 events of one address in one batch: listed once, and no window left behind."""
    events = [line(i % 290, "hot") for i in range(50_000)] + [line(5, "quiet")]
    write_file(f"{scratch}/feed", "0.json", events)
    stream = with_event_time(parse_events(text_stream(spark, f"{scratch}/feed")))
    run_available_now(listings(stream, SPEC, Thresholds(), 24), f"{scratch}/ckpt", "append", path=f"{scratch}/out", state_partitions=2)
    got = spark.read.parquet(f"{scratch}/out").collect()
    start = datetime.fromtimestamp(BASE)
    assert [(r.ipAddress, r.listed_at) for r in got] == [("hot", start)] and got[0].end - start <= timedelta(minutes=10)
    state = spark.read.format("statestore").option("stateVarName", "windows").load(f"{scratch}/ckpt")
    assert {r.key[0] for r in state.select("key").collect()} == {"quiet"}


def test_query_on_a_session_with_another_state_store(spark, tmp_path):
    """The query brings its own state store, equals its SQL (no address, no listing), and leaves the session's setting alone."""
    key, other = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rng, first = random.Random(5), datetime(2024, 1, 1)
    rows = [(i, first + timedelta(minutes=rng.randrange(9 * 1440)), rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["click", "view", "error"]),
             0.0, rng.choice(['{"k": 1}', '{"k": 2}', None])) for i in range(300)]
    events = spark.createDataFrame(rows + rows[:20], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    with session_conf(spark, {key: other}):
        got = catalog.queries()["stream_state_lookup"](spark, str(tmp_path)).collect()
        assert spark.conf.get(key) == other
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.execute(f"SELECT ipAddress, \"end\", listed_at FROM ({catalog.oracle_sql()['stream_state_lookup']})").fetchall()
    assert sorted((r["ipAddress"], r["end"], r["listed_at"]) for r in got) == sorted(want) and len(want) >= 5


@pytest.mark.parametrize("seed, th", [(4, Thresholds(4, 2.0, 3)), (5, Thresholds(10 ** 6, 1.5, 4))])
def test_rounds_in_order_go_by_address(spark, scratch, seed, th):
    """Events that reach the state by address give what they give one by one."""
    rng, want = random.Random(seed), []
    for k in range(4):
        rows = [(k * 2000 + rng.randrange(2000), rng.choice(["click", "click", "view", "buy"]), rng.choice([None, 1, 2, 3, 4, 5, 6]),
                 rng.choice("aaabc")) for _ in range(70)]
        want += [(BASE + t, kind, cat, ip) for t, kind, cat, ip in rows]
        write_file(f"{scratch}/feed", f"{k}.json", [line(t, ip, kind, cat) for t, kind, cat, ip in rows])
        events = with_event_time(parse_events(text_stream(spark, f"{scratch}/feed")))
        run_available_now(listings(events, SPEC, th, TTL, in_order=True), f"{scratch}/ckpt", "append", path=f"{scratch}/out",
                          no_data_batches=False, state_partitions=2)
    got = spark.read.parquet(f"{scratch}/out").select("ipAddress", F.unix_seconds("end"), F.unix_seconds("listed_at")).collect()
    want = by_hand(want, th)
    assert sorted(map(tuple, got)) == want and len(want) > 5


def test_an_address_is_one_state_row(spark, scratch):
    """However many windows an address has: each row is requests from Python to the state."""
    write_file(f"{scratch}/feed", "0.json", [line(300 * i, ip) for i in range(40) for ip in "ab"])
    stream = with_event_time(parse_events(text_stream(spark, f"{scratch}/feed")))
    run_available_now(listings(stream, SPEC, Thresholds(), 24), f"{scratch}/ckpt", "append", path=f"{scratch}/out",
                      no_data_batches=False, state_partitions=2)
    state = spark.read.format("statestore").option("stateVarName", "windows").load(f"{scratch}/ckpt")
    assert sorted(r.key[0] for r in state.select("key").collect()) == ["a", "b"]


class State:
    """A state handle that counts what is asked of it."""

    def __init__(self):
        self.values, self.timers, self.asked = {}, set(), 0

    def getValueState(self, name, schema):
        return Value(self, name)

    def registerTimer(self, at):
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.asked += 1
        self.timers.remove(at)


class Value:
    def __init__(self, state, name):
        self.state, self.name = state, name

    def get(self):
        self.state.asked += 1
        return self.state.values.get(self.name)

    def update(self, value):
        self.state.asked += 1
        self.state.values[self.name] = value

    def clear(self):
        self.state.asked += 1
        self.state.values.pop(self.name, None)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("seed, duration, slide, th", [(1, 600, 300, Thresholds(4, 2.0, 3)), (2, 700, 300, Thresholds(5, 1.5, 3)),
                                                       (3, 600, 600, Thresholds(3, 1e9, 10 ** 6)), (4, 600, 200, Thresholds(10 ** 6, 0.5, 10 ** 6))])
def test_requests_and_timers_of_an_address(seed, duration, slide, th):
    """A batch is six requests at most, one timer is left, and it clears the address."""
    rng, second = random.Random(seed), 10 ** 6
    state, processor = State(), ListedAddresses(duration * second, slide * second, 900 * second, th)
    processor.init(state)
    out, until, seen, latest = [], -1e18, {}, 0
    for k in range(30):
        batch = sorted((k * 1000 + rng.randrange(1000), rng.choice([0, 0, 1, 2]), rng.choice([None, 1, 2, 3, 4])) for _ in range(rng.randrange(1, 8)))
        rows = [{listed_state.EVENTS: RECORD.pack(t * second, kind << 40 | (0 if cat is None else 1 << 32 | cat))} for t, kind, cat in rng.sample(batch, len(batch))]
        state.asked = 0
        out += [(r["listed_micros"] // second, r["end_micros"] // second) for r in processor.handleInputRows(("a",), iter(rows), Now(latest * 1000))]
        assert state.asked <= 6
        latest = batch[-1][0]
        assert len(state.timers) == 1 and min(state.timers) > latest * 1000
        for t, kind, cat in batch:
            hit = []
            for start in range(t // slide * slide, t - duration, -slide):
                if start >= until:
                    events = seen.setdefault(start, [])
                    events.append((kind, cat))
                    clicks, views = (sum(kind == x for kind, _ in events) for x in (0, 2))
                    if len(events) > th.max_amount or views and clicks / views > th.max_rate or len({c for _, c in events if c is not None}) > th.max_categories:
                        hit.append(start + duration)
            if hit:
                until = t + 900
                want = (t, max(hit))
                assert want in out
                out.remove(want)
    assert out == []
    list(processor.handleExpiredTimer(("a",), Now(min(state.timers)), None))
    assert state.values == {}


def test_gathered_rows_hold_all_events(monkeypatch):
    monkeypatch.setattr(listed_state, "GATHERED", 25)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None]), rng.randrange(-10 ** 15, 10 ** 15), rng.randrange(1 << 42)) for _ in range(90)]
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 10]), (pa.string(), pa.int64(), pa.int64()))], ["ipAddress", "micros", "code"])
               for i in range(0, 90, 10)]
    out = [r for b in gather(iter([*batches, batches[0].slice(0, 0)])) for r in b.to_pylist()]
    got = [(r["ipAddress"], *e) for r in out for e in RECORD.iter_unpack(r["events"])]
    assert sorted(got, key=str) == sorted(rows, key=str)
    assert len([r for r in out if r["ipAddress"] == "a"]) <= 3
