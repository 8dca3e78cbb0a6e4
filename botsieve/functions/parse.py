"""Raw event lines -> event rows.

All steps are built-in column expressions, so they stay inside whole-stage
codegen and run the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botsieve.params import (ANCHORED_OBJECT_PATTERN, BACKSLASH, EVENT_COLUMNS, JSON_FIELDS,
                             OBJECT_PATTERN)

CORRUPT_COLUMN = "_corrupt_record"


def event_schema(time_type: str = "timestamp", corrupt_column: str | None = None) -> T.StructType:
    """Schema of one JSON event; ``time_type`` is ``timestamp`` (P5) or ``long``.

    The fields are declared non-nullable as in the original schema; ``from_json``
    returns them nullable anyway, so nothing below relies on the flag.
    """
    time = T.TimestampType() if time_type == "timestamp" else T.LongType()
    types = (time, T.IntegerType(), T.StringType(), T.StringType())
    fields = [T.StructField(n, t, nullable=False) for n, t in zip(JSON_FIELDS, types)]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType(), nullable=True))
    return T.StructType(fields)


def decode_value(col: Column | str = "value") -> Column:
    """Kafka ``value`` bytes (or any column) as a UTF-8 string."""
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def strip_backslashes(col: Column) -> Column:
    """Remove every backslash, which undoes the escaping of a quoted line."""
    return F.translate(col, BACKSLASH, "")


def cut_object(col: Column, pattern: str = OBJECT_PATTERN) -> Column:
    """The first group of ``pattern``; an empty string when nothing matches."""
    return F.regexp_extract(col, pattern, 1)


def groom(col: Column | str = "value", anchored: bool = False) -> Column:
    """P1-P4 in one expression: string, no backslashes, the ``{...}`` part."""
    pattern = ANCHORED_OBJECT_PATTERN if anchored else OBJECT_PATTERN
    return cut_object(strip_backslashes(decode_value(col)), pattern)


def parsed_once(lines: DataFrame, parsed: Column, name: str) -> DataFrame:
    """``parsed`` as a column ``name`` that is computed once per row.

    Filters on a projected ``from_json`` are pushed below the projection and
    each reference re-parses the line (four parses a row for the null checks
    here). A one-element ``explode`` makes the struct a generated column: the
    filters and field accesses above it read the column instead.
    """
    return lines.select(F.explode(F.array(parsed)).alias(name))


def parse_events(lines: DataFrame, value_col: str = "value", time_type: str = "timestamp",
                 anchored: bool = False, require_keys: bool = True) -> DataFrame:
    """Raw lines -> ``unixTime, categoryId, ipAddress, eventType``.

    ``na.drop`` on the struct drops lines without an object (null struct); a
    line like ``{bad json}`` or ``{}`` gives a struct of nulls and passes it,
    so with ``require_keys`` rows without time or address are dropped too: a
    null time is in no window and a null address must not form a group. A
    missing or non-integer ``category_id`` only nulls that field.
    """
    parsed = (parsed_once(lines, F.from_json(groom(value_col, anchored), event_schema(time_type)), "event")
              .na.drop()
              .select("event.*")
              .toDF(*EVENT_COLUMNS))
    if require_keys:
        parsed = parsed.where(F.col(EVENT_COLUMNS[0]).isNotNull() & F.col(EVENT_COLUMNS[2]).isNotNull())
    return parsed


def with_event_time(events: DataFrame, time_col: str = EVENT_COLUMNS[0]) -> DataFrame:
    """Long epoch seconds (P6 form) -> TIMESTAMP, needed by watermark and window."""
    if isinstance(events.schema[time_col].dataType, T.TimestampType):
        return events
    return events.withColumn(time_col, F.timestamp_seconds(F.col(time_col)))


def corrupt_records(lines: DataFrame, value_col: str = "value",
                    time_type: str = "timestamp") -> DataFrame:
    """Groomed lines the JSON reader could not read, as one ``value`` column.

    Uses the reader's own ``columnNameOfCorruptRecord`` in permissive mode; lines
    without any ``{...}`` are not records at all and are left out.
    """
    schema = event_schema(time_type, corrupt_column=CORRUPT_COLUMN)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    # Both filters sit above the explode, so the grooming regex runs once a line.
    groomed = lines.select(groom(value_col).alias("json"))
    record = F.struct(F.col("json"), F.from_json("json", schema, options)[CORRUPT_COLUMN].alias("bad"))
    return (parsed_once(groomed, record, "r")
            .where((F.col("r.json") != "") & F.col("r.bad").isNotNull())
            .select(F.col("r.bad").alias("value")))


def write_corrupt_records(lines: DataFrame, path: str, value_col: str = "value") -> None:
    """K6: bad rows to a text folder, replacing what is there."""
    corrupt_records(lines, value_col).write.mode("overwrite").text(path)
