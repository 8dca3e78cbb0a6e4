"""Window goldens (FIXTURES section 4) and distinct-count modes."""

import pytest
from pyspark.sql import functions as F

from botsieve.operators.windows import window_features
from botsieve.params import DAILY, Thresholds, WindowSpec
from botsieve.plans.detect import flagged_windows
from botsieve.sources.events import clicks_from_events
from botsieve.sources.tables import table
from conftest import SF0001, SF001


def clicks(spark, sf):
    return clicks_from_events(table(spark, sf, "events"))


@pytest.mark.parametrize("sf,rows", [(SF0001, 21), (SF001, 208)])
def test_daily_flag_counts(spark, sf, rows):
    assert flagged_windows(clicks(spark, sf), DAILY, Thresholds()).count() == rows


def test_daily_breakdown(spark):
    feats = window_features(clicks(spark, SF001), DAILY).cache()
    assert feats.count() == 8099
    assert feats.where("rate > 3").count() == 1
    assert feats.where("categories > 5").count() == 207
    assert feats.where("amount > 10").count() == 0
    assert feats.where("rate IS NULL").count() == 4876
    feats.unpersist()


def test_ten_minute_windows(spark):
    feats = window_features(clicks(spark, SF001), WindowSpec())
    assert feats.count() == 19858
    assert feats.where("amount > 10 OR rate > 3 OR categories > 5").count() == 0


def test_distinct_modes_agree(spark):
    ev = clicks(spark, SF001)
    a = window_features(ev, DAILY, distinct_mode="set")
    b = window_features(ev, DAILY, distinct_mode="exact")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_event_in_two_windows(spark):
    feats = window_features(clicks(spark, SF0001), WindowSpec())
    total = feats.agg(F.sum("amount")).first()[0]
    assert total == 2 * clicks(spark, SF0001).count()


def test_thresholds_are_parameters(spark):
    ev = clicks(spark, SF001)
    strict = flagged_windows(ev, DAILY, Thresholds(max_amount=1000, max_rate=1e9, max_categories=1000))
    assert strict.count() == 0


def test_approx_distinct_mode(spark):
    ev = clicks(spark, SF001)
    exact = window_features(ev, DAILY, "exact").withColumnRenamed("categories", "exact")
    approx = window_features(ev, DAILY, "approx").withColumnRenamed("categories", "approx")
    assert dict(approx.dtypes)["approx"] == "int"
    joined = exact.join(approx, ["window", "ipAddress"])
    assert joined.count() == 8099
    # HyperLogLog++ has a 5% relative *standard* error: a bound on average,
    # not on every group (a set of 3 can read as 2).
    mean_err = joined.select(F.avg(F.abs(F.col("approx") - F.col("exact")) / F.col("exact"))).first()[0]
    assert mean_err <= 0.05
