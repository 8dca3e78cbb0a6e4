"""J3 with a non-equi condition: points in intervals, as an equi-join on bins.

``start <= t < end`` alone would be a nested loop over all pairs. Here time is
cut into bins; an interval is listed under each bin it touches, a point under
its own, both are joined on (keys, bin), and the condition is verified.

*Long intervals.* Bins come in levels, each ``SPREAD`` times as wide as the one
before. An interval lies on the first level where it touches at most
``SPREAD + 1`` bins, so it is listed that many times at most, be it a minute or a
year long. A point is listed once for each level in use, which is counted first
(one small aggregate; at most ``LEVELS`` numbers come back).

*Skew.* A key with a third of all points is spread over its bins. What is left in
one (key, bin) is one join partition, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botsieve.operators.blocklist import BROADCAST_MAX_ROWS, fits_broadcast

SPREAD, LEVELS = 8, 16


def bin_of(micros: Column, width: Column) -> Column:
    return F.floor(micros / width).cast("bigint")


def range_join(points: DataFrame, intervals: DataFrame, keys: list[tuple[str, str]], time: str, start: str, end: str,
               width_seconds: int = 300, how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of ``points`` with the rows of ``intervals`` of equal keys where
    ``start <= time < end``; all columns of both sides (``inner``), or the points
    with any such interval (``left_semi``) or none (``left_anti``).

    ``keys``: (column of points, column of intervals), at least one. Timestamps
    of any kind; a null key, time or bound matches nothing, and an interval that
    is empty or reversed holds no point. The two sides must not share column
    names in an inner join (see ``jointree``). ``width_seconds``: the finest bin, best near the
    usual interval (a window's slide).
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"not a range join: {how!r}")
    if not keys:
        raise ValueError("a range join needs an equality, or its bins hold all rows")
    both = sorted(set(points.columns) & set(intervals.columns))
    if how == "inner" and both:
        raise ValueError(f"columns of both sides: {both}")
    widths = [w for w in (width_seconds * 1_000_000 * SPREAD ** i for i in range(LEVELS)) if w < 1 << 62]
    if how != "inner":    # only the condition's columns, under names of their own
        named = {f"_key{i}": b for i, (_, b) in enumerate(keys)} | {"_start": start, "_end": end}
        intervals = intervals.select(*[F.col(f"`{c}`").alias(n) for n, c in named.items()])
        keys, start, end = [(a, f"_key{i}") for i, (a, _) in enumerate(keys)], "_start", "_end"
    when = F.unix_micros(F.col(f"`{time}`").cast("timestamp"))
    first, last = (F.unix_micros(F.col(f"`{c}`").cast("timestamp")) for c in (start, end))
    last = last - 1
    # The last level takes what is longer still (its bins are over 10,000 years wide).
    level = F.coalesce(*[F.when(F.floor((last - first) / F.lit(w)) < SPREAD, F.lit(i)) for i, w in enumerate(widths)], F.lit(len(widths) - 1))
    listed = intervals.where(first <= last).withColumn("_level", level)
    used = sorted(r[0] for r in listed.select("_level").distinct().collect())     # at most LEVELS
    wide = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_level") + 1)
    listed = listed.withColumn("_bin", F.explode(F.sequence(bin_of(first, wide), bin_of(last, wide))))
    if fits_broadcast(listed, max_rows):
        listed = F.broadcast(listed)
    fits = (when >= first) & (when <= last)
    for a, b in keys:
        fits = fits & (F.col(f"`{a}`") == F.col(f"`{b}`"))
    if how == "inner":
        places = [F.struct(F.lit(i).alias("_at"), bin_of(when, F.lit(widths[i])).alias("_in")) for i in used or [0]]
        met = points.select("*", F.inline(F.array(*places))).join(
            listed, fits & (F.col("_at") == F.col("_level")) & (F.col("_in") == F.col("_bin")))
        return met.drop("_at", "_in", "_level", "_bin")
    # Level by level, so that a point is never listed twice.
    rest, hits = points, points.where(F.lit(False))
    for i in used:
        on = fits & (F.col("_level") == i) & (bin_of(when, F.lit(widths[i])) == F.col("_bin"))
        hits = hits.unionByName(rest.join(listed, on, "left_semi"))
        rest = rest.join(listed, on, "left_anti")
    return hits if how == "left_semi" else rest
