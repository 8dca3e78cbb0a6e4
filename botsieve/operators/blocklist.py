"""Block list of flagged addresses.

The bot table has one row per address: ``ipAddress string`` (the key),
``end timestamp`` (window end of the flag) and ``created_at timestamp`` (when
the row was written; entries expire ``BLOCK_TTL_HOURS`` after it).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botsieve.functions.features import ts_lit

from botsieve.params import BLOCK_TTL_HOURS, BOT_KEY, BOT_VALUE, STORE_TYPES

BOT_SCHEMA = T.StructType([
    T.StructField(BOT_KEY, T.StringType(), False),
    T.StructField(BOT_VALUE, T.TimestampType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

# A lookup side is broadcast only under this many rows (about 100 bytes a row
# in memory); above it the join shuffles both sides on the address.
BROADCAST_MAX_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """One count of the (small, lookup) side; ``limit(max_rows + 1)`` stops
    the count early when the side is large."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a measured bound."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def empty_bots(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOT_SCHEMA)


def flagged_ips(flagged: DataFrame) -> DataFrame:
    """``select("ipAddress", "window.end")`` of flagged windows."""
    return flagged.select(F.col(BOT_KEY), F.col("window.end").alias(BOT_VALUE))


def one_row_per_ip(ips: DataFrame) -> DataFrame:
    """Reduce to the key: the latest ``end`` per address (an address can be
    flagged in two overlapping windows of one batch)."""
    return ips.groupBy(BOT_KEY).agg(F.max(BOT_VALUE).alias(BOT_VALUE))


def active(bots: DataFrame, as_of: datetime | None = None,
           ttl_hours: int = BLOCK_TTL_HOURS) -> DataFrame:
    """K4: entries that exist and have not expired at ``as_of``:
    ``as_of - ttl < created_at <= as_of`` (expiry counts from creation).

    Expiry is lazy as in a created-expiry cache: expired rows stay in storage
    and are only hidden; ``compact`` drops them for good. ``as_of=None`` means
    no expiry check.
    """
    if as_of is None:
        return bots
    cutoff = as_of - timedelta(hours=ttl_hours)
    return bots.where((F.col("created_at") > ts_lit(cutoff)) & (F.col("created_at") <= ts_lit(as_of)))


# Salt buckets for a shuffled lookup on a stream: AQE's skew-join split does
# not run on micro-batches, so a hot address would sit in one task.
STREAM_SALT_BUCKETS = 32


def _lookup(events: DataFrame, bots: DataFrame, how: str, broadcast: bool,
            salt_buckets: int | None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    side = bots.select(F.col(BOT_KEY).alias("cachedIp"))
    if broadcast and fits_broadcast(side, max_rows):
        return events.join(F.broadcast(side), events[BOT_KEY] == side["cachedIp"], how)
    if salt_buckets is None:
        salt_buckets = STREAM_SALT_BUCKETS if events.isStreaming else 1
    if salt_buckets <= 1:
        return events.join(side, events[BOT_KEY] == side["cachedIp"], how)
    return salted_join(events, side, BOT_KEY, "cachedIp", how, salt_buckets)


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
                buckets: int) -> DataFrame:
    """Equi-join split over ``buckets`` salts. Each left row's salt is a hash
    of the whole row (the same on a retried task, unlike a random number);
    each right row is repeated once per salt. A hot key is spread over
    ``buckets`` tasks. Exact for inner, left semi and left anti joins: a left
    row meets every right row of its key in its own bucket."""
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"salting is exact only for inner/semi/anti joins, not {how!r}")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets)).cast("int")
    salted_left = left.withColumn("_salt", salt)
    salted_right = (right.withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))))
    cond = (salted_left[left_key] == salted_right[right_key]) & (salted_left["_salt"] == salted_right["_rsalt"])
    joined = salted_left.join(salted_right, cond, how).drop("_salt")
    return joined.drop("_rsalt") if how == "inner" else joined


def antijoin_bots(events: DataFrame, bots: DataFrame, broadcast: bool = True,
                  salt_buckets: int | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Events whose address is not on the list.

    An event with a null address never matches and stays. The list is keyed
    and small next to the event stream, so it is broadcast when its size is
    within the checked bound (the replicated table of the original); beyond it
    the join shuffles: in batch AQE splits skewed partitions, on a stream the
    join is salted (``salt_buckets``, default 32 for streams, 1 in batch). No
    ``distinct`` on the list: duplicate keys on the build side do not change a
    semi or anti join.
    """
    return _lookup(events, bots, "left_anti", broadcast, salt_buckets, max_rows)


def semijoin_bots(events: DataFrame, bots: DataFrame, broadcast: bool = True,
                  salt_buckets: int | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Events whose address is on the list (the positive cache probe)."""
    return _lookup(events, bots, "left_semi", broadcast, salt_buckets, max_rows)


def new_entries(flagged: DataFrame, current: DataFrame, created_at: datetime | None = None,
                as_of: datetime | None = None, ttl_hours: int = BLOCK_TTL_HOURS) -> DataFrame:
    """K1/K2 as a bulk put-if-absent: rows for addresses not yet (actively) listed.

    ``flagged`` has ``ipAddress`` and either ``window`` or ``end``. The first
    writer wins: an address already active keeps its row. Replaying the same
    batch adds nothing, so a retried micro-batch is harmless.
    """
    if "window" in flagged.columns:
        flagged = flagged_ips(flagged)
    ips = one_row_per_ip(flagged.where(F.col(BOT_KEY).isNotNull()))
    listed = active(current, as_of, ttl_hours).select(BOT_KEY)
    stamp = ts_lit(created_at) if created_at else F.current_timestamp()
    return (ips.join(listed, BOT_KEY, "left_anti")
            .select(BOT_KEY, BOT_VALUE, stamp.alias("created_at")))


def merge_into(path: str, flagged: DataFrame, created_at: datetime | None = None,
               as_of: datetime | None = None, ttl_hours: int = BLOCK_TTL_HOURS) -> int:
    """Append new entries to the parquet bot table at ``path``; returns rows added.

    The new rows are counted before the append; the append job commits its
    files only at its end, so a recomputation of ``fresh`` (a lost executor)
    still reads the table as it was before this merge.
    """
    spark = flagged.sparkSession
    current = read_bots(spark, path)
    fresh = new_entries(flagged, current, created_at, as_of, ttl_hours).persist()
    try:
        added = fresh.count()
        if added:
            files = max(1, added // 1_000_000)
            fresh.coalesce(files).write.mode("append").parquet(path)
        return added
    finally:
        fresh.unpersist()


def write_bots(bots: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1/K5: write a bot table (flat columns only; see ``store_types``)."""
    store_types(bots.schema)
    bots.select(*BOT_SCHEMA.fieldNames()).write.mode(mode).parquet(path)


def read_bots(spark: SparkSession, path: str) -> DataFrame:
    """S3: the bot table as a batch DataFrame; an absent table reads as empty."""
    try:
        return spark.read.schema(BOT_SCHEMA).parquet(path)
    except Exception as exc:  # path does not exist yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return empty_bots(spark)
        raise


def compact(spark: SparkSession, path: str, target: str, as_of: datetime) -> DataFrame:
    """Clean-up job: rewrite only the active rows to ``target``."""
    kept = active(read_bots(spark, path), as_of)
    kept.write.mode("overwrite").parquet(target)
    return spark.read.schema(BOT_SCHEMA).parquet(target)


def latest_per_key(df: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` (ties: greatest row).

    A ``max`` over a struct led by ``order_col`` is an ordinary aggregate, so it
    combines map-side and a hot key never gathers its rows in one task.
    """
    rest = [c for c in df.columns if c not in key and c != order_col]
    best = F.max(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("_best")
    return (df.groupBy(*key).agg(best)
            .select(*key, *[F.col(f"_best.{c}").alias(c) for c in [order_col, *rest]])
            .select(*df.columns))


def store_types(schema: T.StructType) -> dict[str, str]:
    """K5: column -> table-store type for a table made from ``schema``.

    Decimal precision/scale, string length and array element type are not
    kept. Map, struct, interval, TIMESTAMP_NTZ and null columns are refused:
    flatten a ``window`` struct (``window.end``) before a write.
    """
    out = {}
    for field in schema.fields:
        name = field.dataType.typeName()
        key = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint"}.get(name, name)
        if key not in STORE_TYPES:
            raise TypeError(f"column {field.name!r}: type {field.dataType.simpleString()} "
                            "has no table-store type")
        out[field.name] = STORE_TYPES[key]
    return out


def create_table_column_types(schema: T.StructType) -> str:
    """K5 for a JDBC table: the ``createTableColumnTypes`` option string."""
    return ", ".join(f"{name} {kind}" for name, kind in store_types(schema).items())
