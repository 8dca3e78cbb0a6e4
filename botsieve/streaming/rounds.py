"""Round driver: feed event-time slices of a table to a file source and run
the streaming job once per slice (``availableNow``).

The rounds stand in for files arriving over time. Each round appends the
lines of one event-time slice to the feed folder (a Spark write job), then
re-plans and runs the streaming query on the same checkpoint. Rounds are
in event-time order, so the watermark only drops data that is really late.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.functions.features import flag_predicate
from botsieve.functions.parse import parse_events, with_event_time
from botsieve.params import Thresholds, WindowSpec
from botsieve.session import ROCKSDB, work_dir
from botsieve.sources.events import event_lines, kafka_records
from botsieve.operators.blocklist import antijoin_bots, latest_per_key, read_bots
from botsieve.operators.committed import CommittedBots
from botsieve.streaming.closing import LateRowsJob, run_closed_windows
from botsieve.streaming.detector import (SHUFFLE_PARTITIONS, block_list_sink, bots_fresh, committed_sink,
                                         default_state_partitions, detect, kafka_events_once, last_values,
                                         run_available_now, session_conf, start_query, text_stream, versioned_sink)
from botsieve.streaming.listed_state import listings
from botsieve.streaming.row_writer import StagedRows, read_rows
from botsieve.streaming.tee import TeeJob

EPOCH = datetime(1970, 1, 1)


def _step(round_days: float | timedelta) -> timedelta:
    return round_days if isinstance(round_days, timedelta) else timedelta(days=round_days)


def round_starts(events: DataFrame, round_days: float | timedelta) -> list[datetime]:
    """Epoch-aligned slice starts covering the table's time range (one
    aggregate row comes back to the driver)."""
    row = events.agg(F.min(F.col("ts").cast("timestamp")).alias("lo"),
                     F.max(F.col("ts").cast("timestamp")).alias("hi")).first()
    if row["lo"] is None:
        return []
    lo, hi = row["lo"].replace(tzinfo=None), row["hi"].replace(tzinfo=None)
    step = _step(round_days)
    first = EPOCH + step * ((lo - EPOCH) // step)
    starts, s = [], first
    while s <= hi:
        starts.append(s)
        s += step
    return starts


def feed_slice(events: DataFrame, feed: str, start: datetime, end: datetime, shaped: bool) -> None:
    """Append the raw lines of events in ``[start, end)`` to the feed folder."""
    event_lines(slice_of(events, start, end), shaped=shaped).write.mode("append").text(feed)


def slice_of(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    # ``ts`` is compared as stored (UTC wall-clock), so the range reaches the scan.
    lo = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    hi = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
    return events.where((F.col("ts") >= lo) & (F.col("ts") < hi))


def stream_flagged_windows(spark: SparkSession, events: DataFrame, spec: WindowSpec,
                           thresholds: Thresholds = Thresholds(), round_days: float | timedelta = 5,
                           root: str | None = None, state_partitions: int | None = None) -> DataFrame:
    """Q1 as a stream: update-mode window aggregates, last value per window
    and address, then the threshold filter. For input in event-time order
    this equals the batch result."""
    root = root or work_dir(spark, "stream-windows")
    feed, ckpt, updates = f"{root}/feed", f"{root}/checkpoint", f"{root}/updates"
    step = _step(round_days)
    for start in round_starts(events, round_days):
        feed_slice(events, feed, start, start + step, shaped=False)
        stream = detect(text_stream(spark, feed), spec, thresholds=None)
        run_available_now(stream, ckpt, "update", batch_fn=versioned_sink(updates),
                          state_partitions=state_partitions or default_state_partitions(spark))
    final = last_values(spark.read.parquet(updates), ["window", "ipAddress"])
    return final.where(flag_predicate(thresholds))


def stream_block_list(spark: SparkSession, events: DataFrame, spec: WindowSpec,
                      thresholds: Thresholds = Thresholds(), round_days: float | timedelta = 5,
                      root: str | None = None, observer=None,
                      state_partitions: int | None = None) -> DataFrame:
    """Q2 (flagship) as a stream: the self-feeding block list.

    Each round: lines -> parse -> anti join with the bot table as it is now
    -> watermark -> windows -> threshold filter -> foreachBatch put-if-absent
    into the bot table. Addresses listed in a round lose their later events
    from the next round on. ``created_at`` of an entry is the end of its round.
    ``observer(round_index, batch_df)`` (optional) sees each batch of flagged
    windows before the merge. Returns the bot table.
    """
    root = root or work_dir(spark, "stream-bots")
    feed, ckpt, bots_path = f"{root}/feed", f"{root}/checkpoint", f"{root}/bots"
    step = _step(round_days)
    for i, start in enumerate(round_starts(events, round_days)):
        feed_slice(events, feed, start, start + step, shaped=False)
        stream = detect(text_stream(spark, feed), spec, thresholds, bots=bots_fresh(spark, bots_path))
        watch = (lambda df, i=i: observer(i, df)) if observer else None
        run_available_now(stream, ckpt, "update",
                          batch_fn=block_list_sink(bots_path, created_at=start + step, observer=watch),
                          state_partitions=state_partitions or default_state_partitions(spark))
    return read_bots(spark, bots_path)


def stream_block_list_expiry(spark: SparkSession, events: DataFrame, spec: WindowSpec, ttl_hours: int,
                             thresholds: Thresholds = Thresholds(), round_days: float | timedelta = 5,
                             root: str | None = None, state_partitions: int | None = None, **table) -> CommittedBots:
    """Q2 with K4: the self-feeding block list whose entries expire while the
    stream runs. Each round drops the events of addresses alive at its start
    and commits what it flags at its end, put-if-absent among the addresses
    alive then, so an address whose entry has expired counts, and may be
    listed, again. Each commit also expires and compacts."""
    root = root or work_dir(spark, "stream-expiry")
    feed, ckpt = f"{root}/feed", f"{root}/checkpoint"
    bots = CommittedBots(spark, f"{root}/bots", **table)
    step = _step(round_days)
    for start in round_starts(events, round_days):
        feed_slice(events, feed, start, start + step, shaped=False)
        stream = detect(text_stream(spark, feed), spec, thresholds, bots=bots.read(start, ttl_hours))
        run_available_now(stream, ckpt, "update",
                          batch_fn=committed_sink(bots.path, ckpt, created_at=start + step, as_of=start + step, ttl_hours=ttl_hours, **table),
                          state_partitions=state_partitions or default_state_partitions(spark))
    return bots


def stream_late_rows(spark: SparkSession, events: DataFrame, spec: WindowSpec, delay: Column,
                     round_days: float | timedelta = 5, root: str | None = None, state_partitions: int | None = None) -> LateRowsJob:
    """Rounds whose rows come out of order. ``delay``: by how many rounds an
    event comes after the round of its time. Returns the job, with the windows
    it kept and the rows that came too late for them."""
    root = root or work_dir(spark, "stream-late")
    job = LateRowsJob(spark, f"{root}/feed", root, spec, state_partitions)
    starts, step = round_starts(events, round_days), _step(round_days)
    delays = [r[0] for r in events.select(delay).distinct().collect()]     # a few numbers
    for n in range(len(starts) + max(delays, default=0)):
        for late in sorted(d for d in delays if 0 <= n - d < len(starts)):
            feed_slice(events.where(delay == late), job.feed, starts[n - late], starts[n - late] + step, shaped=False)
        job.run()
    return job


def stream_closed_windows(spark: SparkSession, events: DataFrame, spec: WindowSpec, run=run_closed_windows,
                          round_days: float | timedelta = 5, root: str | None = None, **options) -> DataFrame | None:
    """W5 (or, with ``run_distinct_categories``, A4 with bounded state): windows
    in append mode, a run per round. None without events."""
    root, out = root or work_dir(spark, "stream-closed"), None
    step = _step(round_days)
    for start in round_starts(events, round_days):
        feed_slice(events, f"{root}/feed", start, start + step, shaped=False)
        out = run(spark, f"{root}/feed", root, spec, **options)
    return out


def stream_tee(spark: SparkSession, events: DataFrame, spec: WindowSpec, round_days: float | timedelta = 5,
               root: str | None = None) -> TeeJob:
    """P16/K6 on a stream: shaped raw lines, a third of them unreadable or not,
    split in events (and their windows) and dead letters, a run per round."""
    root = root or work_dir(spark, "stream-tee")
    job, step = TeeJob(spark, f"{root}/feed", root, spec), _step(round_days)
    for start in round_starts(events, round_days):
        feed_slice(events, job.feed, start, start + step, shaped=True)
        job.run()
    return job


def stream_rows(spark: SparkSession, events: DataFrame, spec: WindowSpec, round_days: float | timedelta = 5,
                root: str | None = None) -> DataFrame:
    """Window updates through the per-row writer; the last row per window
    and address."""
    root = root or work_dir(spark, "stream-rows")
    schema, step = None, _step(round_days)
    for start in round_starts(events, round_days):
        feed_slice(events, f"{root}/feed", start, start + step, shaped=False)
        updates = detect(text_stream(spark, f"{root}/feed"), spec, thresholds=None)
        updates = updates.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "ipAddress", "amount")
        schema = updates.schema
        with session_conf(spark, {SHUFFLE_PARTITIONS: str(default_state_partitions(spark) or 8)}):
            query = (updates.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
                     .foreach(StagedRows(f"{root}/rows", schema)).trigger(availableNow=True).start())
            query.awaitTermination()
    rows = read_rows(spark, f"{root}/rows", schema)
    return latest_per_key(rows, ["window_start", "window_end", "ipAddress"], "epoch").drop("epoch")


def stream_kafka_parse(spark: SparkSession, events: DataFrame, replay: Column, round_days: float | timedelta = 5,
                       horizon: str = "30 days", root: str | None = None) -> DataFrame:
    """Q4/S2 on a stream: Kafka-shaped records (value bytes, partition, offset)
    through a file stream, epoch seconds as a long. Records where ``replay``
    holds are sent twice, in their round and in the next, as a restarted
    producer or a moved consumer group would; a record is told by its partition
    and offset, which are kept as state as long as ``horizon``."""
    root = root or work_dir(spark, "stream-kafka")
    feed, out, step = f"{root}/feed", f"{root}/events", _step(round_days)
    starts = round_starts(events, round_days)
    for first, again in zip([*starts, None], [None, *starts]) if starts else ():
        if first is not None:
            kafka_records(slice_of(events, first, first + step)).write.mode("append").parquet(feed)
        if again is not None:
            kafka_records(slice_of(events, again, again + step).where(replay)).write.mode("append").parquet(feed)
        records = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
        parsed = kafka_events_once(records, horizon)
        run_available_now(parsed, f"{root}/checkpoint", "append", path=out, state_partitions=default_state_partitions(spark))
    return spark.read.parquet(out)


def stream_running(spark: SparkSession, events: DataFrame, spec: WindowSpec, round_days: float | timedelta = 5,
                   root: str | None = None, processing_time: str = "0 seconds") -> DataFrame:
    """A query that never ends, on a processing-time trigger, fed while it
    runs, and stopped once it has caught up. The last values of all windows."""
    root, step = root or work_dir(spark, "stream-running"), _step(round_days)
    feed, updates, query = f"{root}/feed", f"{root}/updates", None
    try:
        for start in round_starts(events, round_days):
            feed_slice(events, feed, start, start + step, shaped=False)
            if query is None:
                with session_conf(spark, {SHUFFLE_PARTITIONS: str(default_state_partitions(spark) or 8)}):
                    query = start_query(detect(text_stream(spark, feed), spec, thresholds=None), f"{root}/checkpoint",
                                        processing_time, batch_fn=versioned_sink(updates))
            query.processAllAvailable()     # rounds come in order
    finally:
        if query is not None:
            query.stop()
    return last_values(spark.read.parquet(updates), ["window", "ipAddress"])


def stream_state_lookup(spark: SparkSession, events: DataFrame, spec: WindowSpec, ttl_hours: float,
                        thresholds: Thresholds = Thresholds(), round_days: float | timedelta = 5,
                        root: str | None = None) -> DataFrame | None:
    """F2/Q3 against keyed state: every listing, a run per round. None without events."""
    root, step = root or work_dir(spark, "stream-state"), _step(round_days)
    events = events.where(F.col("user_id").isNotNull())     # a line would show the address "null"
    starts = round_starts(events, round_days)
    for start in starts:
        feed_slice(events, f"{root}/feed", start, start + step, shaped=False)
        stream = listings(with_event_time(parse_events(text_stream(spark, f"{root}/feed"))), spec, thresholds, ttl_hours, in_order=True)
        # Listings come from events only, so no batch is run for the timers alone.
        run_available_now(stream, f"{root}/checkpoint", "append", path=f"{root}/listings", no_data_batches=False,
                          state_partitions=default_state_partitions(spark), state_store=ROCKSDB)
    return spark.read.parquet(f"{root}/listings") if starts else None


def stream_antijoin(spark: SparkSession, events: DataFrame, bots: DataFrame,
                    root: str | None = None) -> DataFrame:
    """J1 on a stream: parsed lines minus listed addresses, append mode to parquet."""
    root = root or work_dir(spark, "stream-anti")
    feed, ckpt, out = f"{root}/feed", f"{root}/checkpoint", f"{root}/out"
    event_lines(events, shaped=False).write.mode("append").text(feed)
    stream = antijoin_bots(parse_events(text_stream(spark, feed)), bots)
    run_available_now(stream, ckpt, "append", path=out)
    return spark.read.parquet(out)


def stream_text(spark: SparkSession, events: DataFrame, root: str | None = None) -> DataFrame:
    """The shaped raw lines through a text stream source into a parquet sink."""
    root = root or work_dir(spark, "stream-text")
    feed, ckpt, out = f"{root}/feed", f"{root}/checkpoint", f"{root}/out"
    event_lines(events, shaped=True).write.mode("append").text(feed)
    run_available_now(text_stream(spark, feed), ckpt, "append", path=out)
    return spark.read.parquet(out)

