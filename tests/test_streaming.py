"""Streaming goldens (FIXTURES sections 5 and 6) and stream-equals-batch checks."""

import json
import os
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from botsieve.functions.features import flag_predicate
from botsieve.operators.windows import flatten_window
from botsieve.params import DAILY, Thresholds, WindowSpec
from botsieve.plans.detect import flagged_windows
from botsieve.sources.events import clicks_from_events
from botsieve.sources.tables import as_global_view, table
from botsieve.streaming.detector import (RowWriter, detect, run_available_now, text_stream)
from botsieve.streaming.rounds import stream_block_list, stream_flagged_windows
from conftest import SF0001

BASE = 1538076000  # 2018-09-27 19:20:00 UTC


def line(t, ip, kind="view", cat=1):
    return json.dumps({"unix_time": BASE + t, "category_id": cat, "ip": ip, "type": kind}) + ","


def write_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(folder, name))  # atomic: the source never sees half a file


def test_late_data_update_mode(spark, scratch):
    feed, ckpt = f"{scratch}/feed", f"{scratch}/ckpt"
    files = [[line(0, "a"), line(10, "a")], [line(400, "a")], [line(100, "a")],
             [line(2000, "b")], [line(100, "a")]]
    expected = [
        {("19:15", "a", 2), ("19:20", "a", 2)},
        {("19:20", "a", 3), ("19:25", "a", 1)},
        {("19:20", "a", 4)},
        {("19:45", "b", 1), ("19:50", "b", 1)},
        set(),
    ]
    for i, lines in enumerate(files):
        write_file(feed, f"part-{i}.json", lines)
        out = []

        def sink(df, batch_id, out=out):
            out.extend((r["window"]["start"].strftime("%H:%M"), r["ipAddress"], r["amount"])
                       for r in df.collect())

        spark.conf.set("spark.sql.session.timeZone", "UTC")
        stream = detect(text_stream(spark, feed), WindowSpec(), thresholds=None)
        run_available_now(stream, ckpt, "update", batch_fn=sink)
        # rows are rendered in UTC by collect(); compare wall-clock times
        assert {(s, ip, n) for s, ip, n in out} == expected[i], f"file {i}"


def events_frame(spark, rows):
    """Rows (second offset, ip number, type) in the layout of the events table."""
    data = [(i, datetime(2018, 9, 27, 19, 20) + timedelta(seconds=t), ip, kind, 1.0, '{"k": 1}')
            for i, (t, ip, kind) in enumerate(rows)]
    return spark.createDataFrame(
        data, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def test_self_feeding_block_list(spark, scratch):
    a, b, c, d = 1, 2, 3, 4
    files = [[a, a, a, b], [a, b, b], [a, b, c], [c, a, b, c], [c, a, b, d]]
    rows = [(n, ip, "view") for n, ips in enumerate(files) for ip in ips]
    seen = {}

    def observer(i, df):
        seen.setdefault(i, set()).update(r["ipAddress"] for r in df.collect())

    count_over_2 = Thresholds(max_amount=2, max_rate=float("inf"), max_categories=10**9)
    bots = stream_block_list(spark, events_frame(spark, rows), WindowSpec(), count_over_2,
                             round_days=timedelta(seconds=1), root=scratch, observer=observer)
    got = {r["ipAddress"]: r["created_at"] for r in
           bots.select("ipAddress", F.col("created_at").cast("timestamp_ntz").alias("created_at")).collect()}
    start = datetime(2018, 9, 27, 19, 20)
    assert got == {"1": start + timedelta(seconds=1), "2": start + timedelta(seconds=2),
                   "3": start + timedelta(seconds=4)}
    # a flagged in file 0 only: its later events were dropped by the anti join
    assert [seen.get(i, set()) for i in range(5)] == [{"1"}, {"2"}, set(), {"3"}, set()]


def test_stream_equals_batch(spark, scratch):
    ev = table(spark, SF0001, "events")
    streamed = flatten_window(stream_flagged_windows(spark, ev, DAILY, Thresholds(), root=scratch))
    batch = flatten_window(flagged_windows(clicks_from_events(ev), DAILY, Thresholds()))
    assert streamed.count() == 21
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def brute_force_block_list(ev: pd.DataFrame, round_days: int, th: Thresholds):
    """Plain pandas re-computation of the availableNow rounds (daily windows)."""
    ev = ev.copy()
    ev["t"] = ev["ts"].dt.floor("s")
    ev["ip"] = ev["user_id"].astype(str)
    ev["cat"] = ev["props"].map(lambda s: json.loads(s)["k"])
    step = pd.Timedelta(days=round_days)
    epoch = pd.Timestamp("1970-01-01")
    first = epoch + step * ((ev["t"].min() - epoch) // step)
    listed, state = {}, {}
    r = first
    while r <= ev["t"].max():
        part = ev[(ev["t"] >= r) & (ev["t"] < r + step) & ~ev["ip"].isin(listed.keys())]
        touched = set()
        for row in part.itertuples():
            bucket = row.t.floor("12h")
            for start in (bucket, bucket - pd.Timedelta(hours=12)):
                key = (start, row.ip)
                s = state.setdefault(key, {"n": 0, "click": 0, "view": 0, "cats": set()})
                s["n"] += 1
                s["click"] += row.event_type == "click"
                s["view"] += row.event_type == "view"
                s["cats"].add(row.cat)
                touched.add(key)
        batch = {}
        for key in touched:
            s = state[key]
            rate = s["click"] / s["view"] if s["view"] else None
            if s["n"] > th.max_amount or (rate is not None and rate > th.max_rate) or len(s["cats"]) > th.max_categories:
                end = key[0] + pd.Timedelta(days=1)
                batch[key[1]] = max(batch.get(key[1], end), end)
        for ip, end in batch.items():
            listed.setdefault(ip, (end, r + step))
        r += step
    return listed


def test_block_list_against_brute_force(spark, scratch):
    ev = table(spark, SF0001, "events")
    bots = stream_block_list(spark, ev, DAILY, Thresholds(), round_days=5, root=scratch)
    got = {r["ipAddress"]: (r["end"], r["created_at"]) for r in
           bots.select("ipAddress", F.col("end").cast("timestamp_ntz").alias("end"),
                       F.col("created_at").cast("timestamp_ntz").alias("created_at")).collect()}
    pdf = ev.toPandas()
    want = {ip: (end.to_pydatetime(), created.to_pydatetime())
            for ip, (end, created) in brute_force_block_list(pdf, 5, Thresholds()).items()}
    assert got == want and len(got) > 0


def test_foreach_row_writer(spark, scratch):
    feed, ckpt, out = f"{scratch}/feed", f"{scratch}/ckpt", f"{scratch}/puts"
    os.makedirs(out, exist_ok=True)
    write_file(feed, "f0.json", [line(0, "a"), line(1, "a"), line(2, "a"), line(3, "b")])

    def put(key, value, out=out):
        with open(os.path.join(out, f"{key}.txt"), "a") as fh:
            fh.write(f"{value}\n")

    stream = (detect(text_stream(spark, feed), WindowSpec(), Thresholds(max_amount=2))
              .select("ipAddress", F.col("window.end").alias("end")))
    q = (stream.writeStream.outputMode("update").option("checkpointLocation", ckpt)
         .foreach(RowWriter(put=put)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(os.listdir(out)) == ["a.txt"]


def test_global_view_on_stream(spark, scratch):
    feed = f"{scratch}/feed"
    write_file(feed, "f0.json", [line(0, "a")])
    view = as_global_view(text_stream(spark, feed), "raw_lines")
    assert view.isStreaming


def test_null_address_stays_in_anti_join(spark):
    from botsieve.operators.blocklist import antijoin_bots
    events = spark.createDataFrame([("a",), (None,), ("b",)], "ipAddress string")
    bots = spark.createDataFrame([("a",)], "ipAddress string")
    assert sorted(r[0] or "" for r in antijoin_bots(events, bots).collect()) == ["", "b"]


def test_detector_job_ticks(spark, scratch):
    from botsieve.operators.blocklist import read_bots
    from botsieve.plans.jobs import DetectorJob
    src = f"{scratch}/src"
    count_over_2 = Thresholds(max_amount=2, max_rate=float("inf"), max_categories=10**9)
    job = DetectorJob(spark, bots_path=f"{scratch}/bots", checkpoint=f"{scratch}/ckpt", source_dir=src,
                      thresholds=count_over_2)
    files = [["a", "a", "a", "b"], ["a", "b", "b"], ["a", "b", "c"], ["c", "a", "b", "c"], ["c", "a", "b", "d"]]
    listed = []
    for n, ips in enumerate(files):
        write_file(src, f"f{n}.json", [line(n, ip) for ip in ips])
        job.tick()
        listed.append(sorted(r[0] for r in read_bots(spark, job.bots_path).select("ipAddress").collect()))
    assert listed == [["a"], ["a", "b"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c"]]


def test_processing_time_query_and_console(spark, scratch):
    from botsieve.streaming.detector import start_query
    feed = f"{scratch}/feed"
    write_file(feed, "f0.json", [line(0, "a"), line(1, "b")])
    seen = []
    q = start_query(detect(text_stream(spark, feed), WindowSpec(), thresholds=None), f"{scratch}/ckpt",
                    processing_time="1 second", batch_fn=lambda df, i: seen.append(df.count()))
    q.processAllAvailable()
    q.stop()
    assert sum(seen) == 4  # two addresses x two windows
    run_available_now(text_stream(spark, feed), f"{scratch}/ckpt2", "append", fmt="console")


def test_kafka_options():
    from botsieve.streaming.detector import kafka_options
    assert kafka_options() == {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "ad-events",
                               "failOnDataLoss": "false"}


def test_jobs_cli(spark, scratch):
    from botsieve.operators.blocklist import read_bots
    from botsieve.plans.jobs import main
    src = f"{scratch}/src"
    write_file(src, "f0.json", [line(i, "a") for i in range(4)] + [line(5, "b")])
    main(["detect", "--source", src, "--bots", f"{scratch}/bots", "--checkpoint", f"{scratch}/ckpt",
          "--max-amount", "2", "--ticks", "1"])
    assert [r[0] for r in read_bots(spark, f"{scratch}/bots").select("ipAddress").collect()] == ["a"]
