"""Windows that close: late rows (W4), append mode (W5), bounded state.

A window is closed once the watermark has passed its end. Append mode hands
out each window once, when it closes, and the file sink writes each batch
exactly once, so the output is final: a restart adds nothing and nothing is
taken back. Rows for closed windows are late; ``late_rows`` keeps them.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.functions.features import ADDRESS, CATEGORY, TIME, ts_lit
from botsieve.functions.parse import parse_events, with_event_time
from botsieve.params import Thresholds, WindowSpec
from botsieve.sources.shared_files import SharedFiles
from botsieve.streaming.detector import default_state_partitions, detect, last_values, run_available_now, text_stream, versioned_sink

EPOCH = datetime(1970, 1, 1)


def committed_watermark(spark: SparkSession, checkpoint: str) -> datetime:
    """The watermark (UTC) that the next batch of a query drops late rows by:
    that of its newest committed batch, as its checkpoint has it. The epoch if
    there is none. It is the same before and after a restart."""
    files = SharedFiles(spark)
    done = [int(n) for n in files.names(f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return EPOCH
    metadata = json.loads(files.read(f"{checkpoint}/offsets/{max(done)}").splitlines()[1])
    return EPOCH + timedelta(milliseconds=metadata.get("batchWatermarkMs", 0))


def late_rows(events: DataFrame, spec: WindowSpec, watermark: datetime) -> DataFrame:
    """(window, event) for every event and each of its windows that a query with
    this watermark has closed: what a windowed aggregate drops in silence. An
    event may be late for its first window and in time for its second."""
    windows = events.select(F.window(TIME, spec.duration, spec.slide), "*")
    return windows.where(F.col("window.end") <= ts_lit(watermark))


class LateRowsJob:
    """Window aggregates in update mode, and beside them the rows that come too
    late. A run first writes the late rows of the new input (those below the
    aggregate's committed watermark), then aggregates the same input, as one
    batch each. Both have a checkpoint of their own, and the watermark is read
    from the aggregate's, so a run that is lost at any point and started again
    splits its input in the same way."""

    def __init__(self, spark: SparkSession, feed: str, root: str, spec: WindowSpec, state_partitions: int | None = None):
        self.spark, self.feed, self.root, self.spec = spark, feed, root, spec
        self.partitions = state_partitions or default_state_partitions(spark)

    def lines(self) -> DataFrame:
        return text_stream(self.spark, self.feed)

    def run(self) -> None:
        events = with_event_time(parse_events(self.lines()))
        watermark = committed_watermark(self.spark, f"{self.root}/windows")
        run_available_now(late_rows(events, self.spec, watermark), f"{self.root}/late-rows", "append", path=f"{self.root}/late")
        run_available_now(detect(self.lines(), self.spec, thresholds=None), f"{self.root}/windows", "update",
                          batch_fn=versioned_sink(f"{self.root}/updates"), state_partitions=self.partitions)

    def kept(self) -> DataFrame:
        return last_values(self.spark.read.parquet(f"{self.root}/updates"), ["window", ADDRESS])

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late")


def run_closed_windows(spark: SparkSession, feed: str, root: str, spec: WindowSpec, thresholds: Thresholds | None = None,
                       state_partitions: int | None = None) -> DataFrame:
    """One run of window aggregates in append mode over what is new in ``feed``;
    returns the windows closed so far. In append mode the threshold sees each
    window once, complete, so a flag is never taken back."""
    run_available_now(detect(text_stream(spark, feed), spec, thresholds), f"{root}/closed-windows", "append", path=f"{root}/closed",
                      state_partitions=state_partitions or default_state_partitions(spark))
    return spark.read.parquet(f"{root}/closed")


def distinct_categories(events: DataFrame, spec: WindowSpec) -> DataFrame:
    """A4 on a stream with state of a fixed width: (window, address, categories).

    A ``collect_set`` keeps one growing array per group. Here the first stateful
    step keeps each (window, address, category) once, the second counts them:
    every state row is a key or a number, and both steps forget a window when
    the watermark passes its end. Chained steps need append mode. (Deduplication
    ``within watermark`` would forget a category before its window ends.)
    """
    seen = (events.withWatermark(TIME, spec.watermark)
            .select(F.window(TIME, spec.duration, spec.slide), ADDRESS, CATEGORY)
            .dropDuplicates(["window", ADDRESS, CATEGORY]))
    return seen.groupBy("window", ADDRESS).agg(F.count(CATEGORY).cast("int").alias("categories"))


def run_distinct_categories(spark: SparkSession, feed: str, root: str, spec: WindowSpec,
                            state_partitions: int | None = None) -> DataFrame:
    events = with_event_time(parse_events(text_stream(spark, feed)))
    run_available_now(distinct_categories(events, spec), f"{root}/distinct-categories", "append", path=f"{root}/categories",
                      state_partitions=state_partitions or default_state_partitions(spark))
    return spark.read.parquet(f"{root}/categories")

