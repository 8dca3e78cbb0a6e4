"""Batch detector jobs (Q1, Q2, Q3 in batch form)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botsieve.functions.features import ts_lit
from botsieve.operators.blocklist import active, antijoin_bots, flagged_ips, one_row_per_ip
from botsieve.operators.windows import flag_windows, window_features
from botsieve.params import Thresholds, WindowSpec


def flagged_windows(events: DataFrame, spec: WindowSpec = WindowSpec(),
                    thresholds: Thresholds = Thresholds(), distinct_mode: str = "auto") -> DataFrame:
    """Q1: windows per address that cross a threshold (``window, ipAddress, amount, rate, categories``)."""
    return flag_windows(window_features(events, spec, distinct_mode), thresholds)


def block_list(events: DataFrame, spec: WindowSpec = WindowSpec(),
               thresholds: Thresholds = Thresholds(), distinct_mode: str = "auto") -> DataFrame:
    """Addresses flagged in ``events``, one row each with the latest window end."""
    return one_row_per_ip(flagged_ips(flagged_windows(events, spec, thresholds, distinct_mode)))


def flagged_after_lookup(events: DataFrame, bots: DataFrame, spec: WindowSpec = WindowSpec(),
                         thresholds: Thresholds = Thresholds(), as_of: datetime | None = None,
                         distinct_mode: str = "auto") -> DataFrame:
    """Q2/Q3: drop events of listed addresses first, then window and flag.

    The lookup runs before the aggregation, as in the streaming job: events of a
    listed address never reach its windows.
    """
    kept = antijoin_bots(events, active(bots, as_of))
    return flagged_windows(kept, spec, thresholds, distinct_mode)


def bots_as_of(events: DataFrame, as_of: datetime, spec: WindowSpec = WindowSpec(),
               thresholds: Thresholds = Thresholds(), distinct_mode: str = "auto") -> DataFrame:
    """The bot table a detector run over the events before ``as_of`` leaves:
    ``ipAddress, end, created_at`` with ``created_at = end`` (the earliest time
    the window could be flagged)."""
    early = events.where(F.col("unixTime") < ts_lit(as_of))
    return (block_list(early, spec, thresholds, distinct_mode)
            .withColumn("created_at", F.col("end")))
