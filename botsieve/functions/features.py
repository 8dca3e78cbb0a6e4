"""Aggregate column expressions of a window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botsieve.params import CLICK, EVENT_COLUMNS, VIEW, Thresholds

TIME, CATEGORY, ADDRESS, KIND = EVENT_COLUMNS


def amount(time_col: str = TIME) -> Column:
    """A1: events with a time (``count`` skips nulls)."""
    return F.count(F.col(time_col)).alias("amount")


def count_of_type(kind: str, type_col: str = KIND, time_col: str = TIME) -> Column:
    """Events of one type; ``when`` gives null for the rest."""
    return F.count(F.when(F.col(type_col) == F.lit(kind), F.col(time_col)))


def click_view_rate(type_col: str = KIND, time_col: str = TIME) -> Column:
    """Clicks / views as a double, null when there is no view.

    ``try_divide`` keeps the null-on-zero meaning; a plain ``/`` raises in ANSI mode.
    """
    return F.try_divide(count_of_type(CLICK, type_col, time_col),
                        count_of_type(VIEW, type_col, time_col)).alias("rate")


def distinct_categories(category_col: str = CATEGORY, mode: str = "set") -> Column:
    """Distinct categories of a group, nulls left out.

    ``set``   -- ``size(collect_set(..))``; works in streaming aggregations, the
                 partial set per task is bounded by the number of categories.
    ``exact`` -- ``count(DISTINCT ..)``; batch only. Spark plans it as a first
                 aggregation on (keys, category), which also spreads one hot key
                 over its categories before the final merge.
    ``approx``-- HyperLogLog++, fixed-size state for very many categories.
    All three give an INT column.
    """
    col = F.col(category_col)
    if mode == "set":
        value = F.size(F.collect_set(col))
    elif mode == "exact":
        value = F.count_distinct(col).cast("int")
    elif mode == "approx":
        value = F.approx_count_distinct(col).cast("int")
    else:
        raise ValueError(f"unknown distinct mode {mode!r}")
    return value.alias("categories")


def window_aggregates(distinct_mode: str = "exact") -> list[Column]:
    """The aggregate list of the detector: amount, rate, categories."""
    return [amount(), click_view_rate(), distinct_categories(mode=distinct_mode)]


def flag_predicate(thresholds: Thresholds = Thresholds()) -> Column:
    """three-valued OR; a null rate alone never flags a window."""
    return ((F.col("amount") > F.lit(thresholds.max_amount))
            | (F.col("rate") > F.lit(float(thresholds.max_rate)))
            | (F.col("categories") > F.lit(thresholds.max_categories)))


def ts_lit(value) -> Column:
    """A timestamp literal read in the session time zone (no dependence on the
    Python process's local zone)."""
    return F.lit(value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)).cast("timestamp")
