"""Bot table: put-if-absent, expiry, store types, size-checked broadcast."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botsieve.operators.blocklist import (BOT_SCHEMA, active, antijoin_bots, broadcast_if_small,
                                          create_table_column_types, latest_per_key, merge_into,
                                          read_bots, store_types, write_bots)


def flagged(spark, rows):
    return spark.createDataFrame(
        [(ip, datetime.fromisoformat(s), datetime.fromisoformat(e)) for ip, s, e in rows],
        "ipAddress string, s timestamp, e timestamp").select(
        F.struct(F.col("s").alias("start"), F.col("e").alias("end")).alias("window"), "ipAddress")


def test_merge_is_put_if_absent_and_idempotent(spark, scratch):
    path = f"{scratch}/bots"
    batch = flagged(spark, [("a", "2024-01-01 00:00", "2024-01-01 00:10"),
                            ("a", "2024-01-01 00:05", "2024-01-01 00:15"),
                            ("b", "2024-01-01 00:00", "2024-01-01 00:10")])
    assert merge_into(path, batch, created_at=datetime(2024, 1, 2)) == 2
    assert merge_into(path, batch, created_at=datetime(2024, 1, 3)) == 0  # replay adds nothing
    later = flagged(spark, [("a", "2024-01-05 00:00", "2024-01-05 00:10")])
    assert merge_into(path, later, created_at=datetime(2024, 1, 5)) == 0  # first writer wins
    rows = {r["ipAddress"]: r["end"].replace(tzinfo=None) for r in read_bots(spark, path).collect()}
    assert rows == {"a": datetime(2024, 1, 1, 0, 15), "b": datetime(2024, 1, 1, 0, 10)}


def test_expired_entry_can_be_listed_again(spark, scratch):
    path = f"{scratch}/bots"
    first = flagged(spark, [("a", "2024-01-01 00:00", "2024-01-01 00:10")])
    merge_into(path, first, created_at=datetime(2024, 1, 1))
    again = flagged(spark, [("a", "2024-01-03 00:00", "2024-01-03 00:10")])
    assert merge_into(path, again, created_at=datetime(2024, 1, 3), as_of=datetime(2024, 1, 3)) == 1
    alive = active(read_bots(spark, path), datetime(2024, 1, 3, 12))
    assert [r["created_at"].replace(tzinfo=None) for r in alive.collect()] == [datetime(2024, 1, 3)]


def test_ttl_window(spark):
    rows = [("a", datetime(2024, 1, 1), datetime(2024, 1, 1)),
            ("b", datetime(2024, 1, 1), datetime(2024, 1, 1, 23)),
            ("c", datetime(2024, 1, 1), datetime(2024, 1, 2, 1))]
    bots = spark.createDataFrame(rows, BOT_SCHEMA)
    alive = {r[0] for r in active(bots, datetime(2024, 1, 2)).collect()}
    assert alive == {"b"}  # a expired (exactly 24 h), c not created yet


def test_store_types():
    schema = T.StructType([T.StructField("ipAddress", T.StringType()), T.StructField("end", T.TimestampType()),
                           T.StructField("n", T.LongType()), T.StructField("r", T.DoubleType())])
    assert store_types(schema) == {"ipAddress": "VARCHAR", "end": "TIMESTAMP", "n": "BIGINT", "r": "DOUBLE"}
    assert create_table_column_types(schema).startswith("ipAddress VARCHAR, end TIMESTAMP")
    for bad in (T.StructType([T.StructField("w", T.StructType([T.StructField("s", T.TimestampType())]))]),
                T.StructType([T.StructField("m", T.MapType(T.StringType(), T.StringType()))]),
                T.StructType([T.StructField("t", T.TimestampNTZType())])):
        with pytest.raises(TypeError):
            store_types(bad)


def test_write_refuses_window_struct(spark, scratch):
    batch = flagged(spark, [("a", "2024-01-01 00:00", "2024-01-01 00:10")])
    with pytest.raises(Exception):
        write_bots(batch, f"{scratch}/bad")


def test_broadcast_only_within_bound(spark):
    events = spark.range(1000).select(F.col("id").cast("string").alias("ipAddress"))
    bots = spark.range(10).select(F.col("id").cast("string").alias("ipAddress"))
    small = antijoin_bots(events, bots)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString() or \
        "Broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    assert small.count() == 990
    hinted = broadcast_if_small(bots, max_rows=5)
    assert "broadcast" not in hinted._jdf.queryExecution().logical().toString().lower()


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 3, "y"), ("j", 2, "z")], "key string, v int, p string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["key"], "v").collect())
    assert got == [("j", 2, "z"), ("k", 3, "y")]


def test_shared_root_comes_from_the_session(spark):
    from botsieve.session import shared_root, work_dir
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert work_dir(spark, "x").startswith(root + "/x-")


def test_compact_keeps_active_rows(spark, scratch):
    from botsieve.operators.blocklist import compact
    rows = [("a", datetime(2024, 1, 1), datetime(2024, 1, 1)),
            ("b", datetime(2024, 1, 2), datetime(2024, 1, 2, 6))]
    write_bots(spark.createDataFrame(rows, BOT_SCHEMA), f"{scratch}/bots")
    kept = compact(spark, f"{scratch}/bots", f"{scratch}/bots-compact", datetime(2024, 1, 2, 12))
    assert [r[0] for r in kept.collect()] == ["b"]


def test_cluster_conf_for_100_tb():
    from botsieve.session import cluster_conf
    conf = cluster_conf(100 << 40, cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == "40960"  # 10 TB shuffled, 256 MiB a partition
    assert cluster_conf(100 << 40, cores=8000, shuffle_bytes=100 << 40)["spark.sql.shuffle.partitions"] == "50000"
    assert cluster_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_stored_table_follows_the_events(spark, tmp_path):
    """The catalog's bot table is kept while the files of ``events`` are the same, and derived anew for others."""
    import shutil
    from conftest import SF0001
    from botsieve.plans import catalog
    shutil.copy(f"{SF0001}/events.parquet", tmp_path / "events.parquet")
    first = catalog.bots(spark, str(tmp_path))
    assert first.inputFiles() == catalog.bots(spark, str(tmp_path)).inputFiles() and first.count() > 0
    spark.read.parquet(f"{SF0001}/events.parquet").limit(0).write.mode("overwrite").parquet(str(tmp_path / "other"))
    part = next(p for p in (tmp_path / "other").iterdir() if p.suffix == ".parquet")
    shutil.copy(part, tmp_path / "events.parquet")
    assert catalog.bots(spark, str(tmp_path)).count() == 0
