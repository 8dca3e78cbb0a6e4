"""Structured Streaming jobs (S1, S2, J1 on a stream, W1-W10, K1 in a sink).

The same DataFrame functions as the batch jobs run on ``readStream`` input.
Queries are driven as ``availableNow`` rounds: each round plans the query
anew, so a lookup table written by an earlier round is read fresh, while the
window state carries over in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.functions.features import flag_predicate
from botsieve.functions.parse import parse_events, with_event_time
from botsieve.operators.blocklist import active, antijoin_bots, latest_per_key, merge_into, read_bots
from botsieve.operators.committed import CommittedBots
from botsieve.operators.windows import window_features
from botsieve.params import BLOCK_TTL_HOURS, KAFKA_BOOTSTRAP, KAFKA_TOPIC, Thresholds, WindowSpec


# ----------------------------------------------------------------- sources --

def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files under ``path``, one ``value`` row per line."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def kafka_options(servers: str = KAFKA_BOOTSTRAP, topic: str = KAFKA_TOPIC,
                  fail_on_data_loss: bool = False, **extra) -> dict:
    """Options of the Kafka source (subscribe one topic, tolerate lost offsets).

    Key and value arrive as bytes; ``decode_value`` turns the value into a string.
    """
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, servers: str = KAFKA_BOOTSTRAP, topic: str = KAFKA_TOPIC,
                 **extra) -> DataFrame:
    """The Kafka source (needs the spark-sql-kafka package on the classpath)."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **extra)).load()


# ------------------------------------------------------------------- plans --

def detect(lines: DataFrame, spec: WindowSpec = WindowSpec(), thresholds: Thresholds | None = Thresholds(),
           bots: DataFrame | None = None, value_col: str = "value", time_type: str = "timestamp") -> DataFrame:
    """Q1/Q2 on a stream: parse, optional lookup, watermark, window, optional filter.

    ``thresholds=None`` keeps every window (for last-value-per-key output).
    """
    events = with_event_time(parse_events(lines, value_col, time_type))
    if bots is not None:
        events = antijoin_bots(events, bots)
    feats = window_features(events, spec, distinct_mode="set", watermark=True)
    if thresholds is not None:
        feats = feats.where(flag_predicate(thresholds))
    return feats


def kafka_events_once(records: DataFrame, horizon: str) -> DataFrame:
    """Q4: Kafka records -> events (epoch seconds as a long), each record once.
    Ranges of offsets that come again are dropped by (partition, offset), kept as
    state until the records' own time is ``horizon`` past."""
    once = records.withWatermark("timestamp", horizon).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
    return parse_events(once, "value", time_type="long")


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_available_now(df: DataFrame, checkpoint: str, output_mode: str = "update",
                      batch_fn: Callable[[DataFrame, int], None] | None = None,
                      path: str | None = None, fmt: str = "parquet", query_name: str | None = None,
                      no_data_batches: bool | None = None, state_partitions: int | None = None,
                      state_store: dict[str, str] | None = None) -> None:
    """Start, process everything available, stop (W5, W6, W10 with ``availableNow``).

    Either ``batch_fn`` (``foreachBatch``) or a file sink at ``path``.
    ``no_data_batches`` (default: the session setting) controls the batch that
    only moves the watermark. Keep it on where late data matters: since Spark
    3.4 late rows are filtered with the previous batch's watermark, so without
    that batch a late row still reaches a window that is already closed.
    ``state_partitions`` sets the shuffle (and state store) partitions of a new
    checkpoint; a restarted query keeps the count in its checkpoint.
    ``state_store``: settings of the state store, for a query that needs a
    certain one (default: the session settings).
    """
    overrides = dict(state_store or {})
    if no_data_batches is not None:
        overrides[NO_DATA_BATCHES] = str(no_data_batches).lower()
    if state_partitions:
        overrides[SHUFFLE_PARTITIONS] = str(state_partitions)
    with session_conf(df.sparkSession, overrides):
        _start_and_wait(df, checkpoint, output_mode, batch_fn, path, fmt, query_name)


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def session_conf(spark: SparkSession, overrides: dict[str, str]):
    """SQL settings for the start of one query (a query keeps the values it
    started with), restored afterwards."""
    previous = {k: spark.conf.get(k, None) for k in overrides}
    for k, v in overrides.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def default_state_partitions(spark: SparkSession) -> int | None:
    """One state partition per core the application has (None when the
    session does not expose a context)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return None


def _start_and_wait(df, checkpoint, output_mode, batch_fn, path, fmt, query_name) -> None:
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if batch_fn is not None:
        writer = writer.foreachBatch(batch_fn)
    else:
        writer = writer.format(fmt)
        if path is not None:
            writer = writer.option("path", path)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def start_query(df: DataFrame, checkpoint: str, processing_time: str = "2 seconds",
                output_mode: str = "update", fmt: str = "console",
                batch_fn: Callable[[DataFrame, int], None] | None = None, **options):
    """A never-ending query on a processing-time trigger (console by
    default); returns the running ``StreamingQuery``."""
    writer = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
              .trigger(processingTime=processing_time))
    writer = writer.foreachBatch(batch_fn) if batch_fn is not None else writer.format(fmt).options(**options)
    return writer.start()


def versioned_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: each batch to ``path/batch_id=N``, overwritten on replay,
    so a retried batch never duplicates rows. One write, one evaluation of the
    batch; a watermark-only batch leaves an empty folder that reads as nothing."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


def last_values(updates: DataFrame, key: list[str]) -> DataFrame:
    """The final value of every group out of update-mode batches: the row of
    the highest batch id per key (a map-side combinable max)."""
    return latest_per_key(updates, key, "batch_id").drop("batch_id")


def block_list_sink(bots_path: str, created_at: datetime | None = None,
                    as_of: datetime | None = None, observer=None,
                    ttl_hours: int = BLOCK_TTL_HOURS) -> Callable[[DataFrame, int], None]:
    """W6 + K1: each batch of flagged windows merged into the bot table,
    put-if-absent, one row per address with the latest window end of the batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        if observer is not None:
            observer(batch)
        merge_into(bots_path, batch, created_at=created_at, as_of=as_of, ttl_hours=ttl_hours)
    return sink


def committed_sink(bots_path: str, stream: str, created_at: datetime | None = None, as_of: datetime | None = None,
                   ttl_hours: int = BLOCK_TTL_HOURS, **table) -> Callable[[DataFrame, int], None]:
    """W6 + K1-K4: each batch as one commit of the commit-logged bot table.
    ``stream`` names the query, so a replayed batch is recognised."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        CommittedBots(batch.sparkSession, bots_path, **table).merge(
            batch, created_at=created_at, as_of=as_of, ttl_hours=ttl_hours, batch=(stream, batch_id))
    return sink


class RowWriter:
    """Single puts into an outside store (``writeStream.foreach``).

    ``put`` is called with (key, value) for each row, again if a task is retried,
    so it must be a put-if-absent or otherwise idempotent. Rows that Spark is to
    keep go to ``row_writer.StagedRows`` (each exactly once) or, in bulk, to
    ``block_list_sink`` and ``committed_sink``.
    """

    def __init__(self, put: Callable, key: str = "ipAddress", value: str = "end"):
        self.key, self.value, self.put = key, value, put

    def open(self, partition_id, epoch_id):
        return True

    def process(self, row):
        self.put(row[self.key], row[self.value])

    def close(self, error):
        if error:
            raise error


def bots_fresh(spark: SparkSession, bots_path: str, as_of: datetime | None = None,
               ttl_hours: int = BLOCK_TTL_HOURS) -> DataFrame:
    """The lookup side of one round, read anew when the round is planned;
    with ``as_of`` only the entries alive then (created-expiry)."""
    return active(read_bots(spark, bots_path), as_of, ttl_hours)
