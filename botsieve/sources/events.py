"""The ``events`` test table as the detector's input.

Mapping (the table has no IP or category column of its own):
``ipAddress = cast(user_id as string)``, ``categoryId = props.k`` as int,
``eventType = event_type``, ``unixTime = cast(ts as timestamp)`` read in UTC.
``ts`` is TIMESTAMP_NTZ in the files and ``withWatermark`` refuses that type,
so the cast is compulsory.

Raw lines (the form the parser reads) are rendered from the same rows by
Spark; see ``event_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botsieve.params import EVENT_COLUMNS

TIME, CATEGORY, ADDRESS, KIND = EVENT_COLUMNS

# Line shapes of the rendered feed, chosen by event type so that every
# grooming path is exercised by real rows:
#   plain   {"unix_time": 1538076151, "category_id": 1009, "ip": "...", "type": "view"},
#   quoted  the plain object as a JSON string, quotes escaped (the Kafka form)
#   array   [ + plain object + ,   (first line of a JSON array file)
#   broken  object with unquoted keys, which no JSON reader accepts
LINE_SHAPES = {"view": "plain", "click": "plain", "purchase": "quoted",
               "signup": "array", "error": "broken"}


def category_of(props: Column) -> Column:
    """``props.k`` as an int; a value that is not an integer gives null (as
    ``from_json`` does for ``category_id``), also under ANSI casts."""
    return F.get_json_object(props, "$.k").try_cast("int")


def clicks_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> ``unixTime timestamp, categoryId int, ipAddress string, eventType string``."""
    return events.select(
        F.col("ts").cast("timestamp").alias(TIME),
        category_of(F.col("props")).alias(CATEGORY),
        F.col("user_id").cast("string").alias(ADDRESS),
        F.col("event_type").alias(KIND),
    )


def _object(unix: Column, category: Column, ip: Column, kind: Column, quote: str = '"') -> Column:
    q = quote
    return F.format_string(
        "{" + f'{q}unix_time{q}: %d, {q}category_id{q}: %d, {q}ip{q}: "%s", {q}type{q}: "%s"' + "}",
        unix, category, ip, kind)


def event_lines(events: DataFrame, shaped: bool = True, keep_time: bool = False) -> DataFrame:
    """Render ``events`` as raw lines, one ``value string`` per event.

    ``unix_time`` is whole epoch seconds (the fraction of ``ts`` is cut). With
    ``shaped`` the line shape follows ``LINE_SHAPES``; otherwise every line is
    plain. ``keep_time`` adds the event time (``ts``) for partitioning a feed.
    The fields and the plain object are projected first, so the shapes read
    them as columns and each row renders its object once.
    """
    fields = events.select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("_unix"),
        category_of(F.col("props")).alias("_cat"),
        F.col("user_id").cast("string").alias("_ip"),
        F.col("event_type").alias("_kind"),
        F.col("ts"))
    unix, category, ip, kind = (F.col(c) for c in ("_unix", "_cat", "_ip", "_kind"))
    staged = fields.withColumn("_plain", _object(unix, category, ip, kind))
    plain = F.col("_plain")
    if shaped:
        line = (F.when(kind == "purchase", F.concat(_quote(plain), F.lit(",")))
                .when(kind == "signup", F.concat(F.lit("["), plain, F.lit(",")))
                .when(kind == "error", _object(unix, category, ip, kind, quote=""))
                .otherwise(F.concat(plain, F.lit(","))))
    else:
        line = F.concat(plain, F.lit(","))
    cols = [line.alias("value")]
    if keep_time:
        cols.append(F.col("ts"))
    return staged.select(*cols)


def _quote(line: Column) -> Column:
    """The line as a JSON string: wrapped in quotes, inner quotes escaped."""
    return F.concat(F.lit('"'), F.replace(line, F.lit('"'), F.lit('\\"')), F.lit('"'))


def kafka_records(events: DataFrame, topic: str = "ad-events", partitions: int = 3) -> DataFrame:
    """Kafka-shaped rows (key, value bytes, topic, partition, offset, timestamp).

    What the Kafka source hands over, built from ``events``: the value is the
    plain object as a JSON string, as a schemaless JSON converter of a file
    feed writes it.
    """
    plain = _object(F.unix_seconds(F.col("ts").cast("timestamp")), category_of(F.col("props")),
                    F.col("user_id").cast("string"), F.col("event_type"))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(_quote(plain), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
