"""Sliding-window aggregation per address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botsieve.functions.features import ADDRESS, TIME, flag_predicate, window_aggregates
from botsieve.params import Thresholds, WindowSpec


def window_features(events: DataFrame, spec: WindowSpec = WindowSpec(),
                    distinct_mode: str = "auto", watermark: bool | None = None) -> DataFrame:
    """``groupBy(window(unixTime, duration, slide), ipAddress)`` -> amount, rate, categories.

    Works on batch and streaming input alike. A streaming input gets the
    watermark (``watermark=None`` means: only when the input is streaming).
    Every event falls in ``duration / slide`` windows; Spark expands the rows
    and aggregates partially before the shuffle on (window, address), so what
    crosses the network is one partial row per group and task, even for an
    address that sends a third of all events.

    ``distinct_mode="auto"``: ``count(DISTINCT)`` in batch (codegen'd, and its
    first shuffle on (window, address, category) spreads a hot address), the
    ``collect_set`` form on streams, where distinct aggregates are not allowed.
    """
    if distinct_mode == "auto":
        distinct_mode = "set" if events.isStreaming else "exact"
    if watermark is None:
        watermark = events.isStreaming
    if watermark:
        events = events.withWatermark(TIME, spec.watermark)
    return (events
            .groupBy(F.window(TIME, spec.duration, spec.slide), ADDRESS)
            .agg(*window_aggregates(distinct_mode)))


def flag_windows(features: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """F1 on the window aggregate."""
    return features.where(flag_predicate(thresholds))


def flatten_window(df: DataFrame, ntz: bool = False) -> DataFrame:
    """``window struct<start,end>`` -> ``window_start, window_end`` first.

    ``ntz`` gives TIMESTAMP_NTZ wall-clock values in the session time zone, the
    form a table store or an outside SQL engine reads without zone shifts.
    """
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != "window"]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)
