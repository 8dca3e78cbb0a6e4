"""Plan shape and skew: what must hold for the plans to survive a 1000x scale-up."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from botsieve.plans import catalog
from botsieve.operators.blocklist import antijoin_bots
from botsieve.operators.windows import window_features
from botsieve.params import DAILY
from botsieve.sources.events import clicks_from_events
from botsieve.sources.tables import table
from conftest import SF001

STREAMING_KEYS = {key for key in catalog.QUERIES if key.startswith("stream_")}


def plan(df, mode="formatted"):
    """The plan text as ``explain`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def hot_clicks(spark):
    """events with a third of all rows moved to one address (a skew fixture)."""
    ev = clicks_from_events(table(spark, SF001, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))))
    return ev


def test_hot_address_window_counts(spark):
    ev = hot_clicks(spark)
    exact = window_features(ev, DAILY, "exact")
    by_set = window_features(ev, DAILY, "set")
    assert exact.exceptAll(by_set).count() == 0 and by_set.exceptAll(exact).count() == 0
    hot = exact.where("ipAddress = '-1'").agg(F.sum("amount")).first()[0]
    assert hot == 2 * ev.where("ipAddress = '-1'").count()  # every event in two daily windows


def test_partial_aggregation_before_shuffle(spark):
    p = plan(window_features(hot_clicks(spark), DAILY), "simple")
    assert p.index("partial_count") > p.index("Exchange")  # tree printed top-down: partial is below
    assert "Expand" in p


def test_hot_address_anti_join_without_broadcast(spark):
    ev = hot_clicks(spark)
    bots = spark.createDataFrame([("-1",), ("7",)], "ipAddress string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = antijoin_bots(ev, bots, broadcast=False)
        assert "BroadcastHashJoin" not in plan(kept)
        n = kept.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n == ev.where("ipAddress NOT IN ('-1', '7')").count()


def test_filters_and_columns_reach_the_scan(spark):
    q = catalog.queries()
    p = plan(q["table_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_discount), IsNotNull(l_quantity), " \
           "GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double," \
           "l_shipdate:timestamp_ntz>" in p
    p = plan(q["table_project"](spark, SF001))
    assert "l_tax" not in p and "l_returnflag" not in p


def test_time_slices_reach_the_scan(spark):
    from botsieve.plans.detect import bots_as_of
    from botsieve.plans.catalog import AS_OF
    p = plan(bots_as_of(clicks_from_events(table(spark, SF001, "events")), AS_OF, DAILY))
    assert "LessThan(ts,2024-01-15T00:00)" in p


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - STREAMING_KEYS))
def test_no_python_in_query_plans(spark, name):
    p = plan(catalog.queries()[name](spark, SF001))
    assert "EvalPython" not in p and "PythonUDF" not in p and "FlatMapGroupsInPandas" not in p


@pytest.mark.parametrize("how", ["anti", "semi"])
def test_salted_lookup_is_exact(spark, how):
    from botsieve.operators.blocklist import semijoin_bots
    ev = hot_clicks(spark)
    bots = spark.createDataFrame([("-1",), ("7",), ("8",)], "ipAddress string")
    fn = antijoin_bots if how == "anti" else semijoin_bots
    salted = fn(ev, bots, broadcast=False, salt_buckets=8)
    plain = fn(ev, bots, broadcast=True)
    assert "_salt" not in salted.columns and salted.columns == ev.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_stream_lookup_above_bound_is_salted(spark, scratch):
    import json as _json
    import os
    from botsieve.functions.parse import parse_events
    from botsieve.streaming.detector import run_available_now, text_stream
    feed = f"{scratch}/feed"
    os.makedirs(feed)
    with open(f"{feed}/f0.json", "w") as fh:
        for i, ip in enumerate(["a"] * 30 + ["b", "c"]):
            fh.write(_json.dumps({"unix_time": 1538076000 + i, "category_id": 1, "ip": ip, "type": "view"}) + "\n")
    bots = spark.createDataFrame([("a",)], "ipAddress string")
    stream = antijoin_bots(parse_events(text_stream(spark, feed)), bots, max_rows=0)
    assert "xxhash64" in plan(stream, "extended")
    run_available_now(stream, f"{scratch}/ckpt", "append", path=f"{scratch}/out")
    assert sorted(r[0] for r in spark.read.parquet(f"{scratch}/out").select("ipAddress").collect()) == ["b", "c"]


def test_streaming_detector_plan(spark, scratch):
    import os
    from botsieve.params import WindowSpec
    from botsieve.streaming.detector import detect, text_stream
    os.makedirs(f"{scratch}/feed")
    with open(f"{scratch}/feed/f0.json", "w") as fh:
        fh.write('{"unix_time": 1538076000, "category_id": 1, "ip": "a", "type": "view"}\n')
    bots = spark.createDataFrame([("z",)], "ipAddress string")
    p = plan(detect(text_stream(spark, f"{scratch}/feed"), WindowSpec(), bots=bots), "extended")
    physical = p[p.index("== Physical Plan =="):]
    assert "StateStoreSave" in physical and "StateStoreRestore" in physical
    assert "partial_count" in physical and "EventTimeWatermark" in physical
    assert "BroadcastHashJoin" in physical and "LeftAnti" in physical
    assert "EvalPython" not in physical
