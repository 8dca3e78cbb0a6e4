"""Parameters of the detector.

Every value under "Fixed values" must stay equal to the behaviour being
rebuilt; the dataclasses make each of them a parameter with that value as
the default.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must match the rebuilt detector for equal results)
# ---------------------------------------------------------------------------
# JSON field names of a raw event line, in order.
JSON_FIELDS = ("unix_time", "category_id", "ip", "type")
# Column names after parsing, by position.
EVENT_COLUMNS = ("unixTime", "categoryId", "ipAddress", "eventType")
# Event types that enter the click/view rate.
CLICK = "click"
VIEW = "view"
# Line grooming: every backslash is removed, then the greedy object pattern
# cuts from the first "{" to the last "}".
BACKSLASH = "\\"
OBJECT_PATTERN = r"(\{.*\})"
# Anchored variant for lines of a JSON array: optional "[", the object, then
# an optional "," or "]".
ANCHORED_OBJECT_PATTERN = r"^\[?(\{.*\})[\,\]]?$"
# Window, slide and watermark of the streaming detector.
WINDOW_DURATION = "10 minutes"
SLIDE_DURATION = "5 minutes"
WATERMARK_DELAY = "1 minute"
# Thresholds: a window is flagged when amount > 10 OR rate > 3 OR categories > 5.
MAX_AMOUNT = 10
MAX_RATE = 3.0
MAX_CATEGORIES = 5
# Block-list entries expire 24 hours after they were created.
BLOCK_TTL_HOURS = 24
# Bot table: key column and value column.
BOT_KEY = "ipAddress"
BOT_VALUE = "end"
# Spark type -> table-store type accepted for a bot table; other types refused.
STORE_TYPES = {
    "boolean": "BOOLEAN",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INT",
    "bigint": "BIGINT",
    "decimal": "DECIMAL",
    "double": "DOUBLE",
    "float": "REAL",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "string": "VARCHAR",
    "binary": "BINARY",
    "array": "ARRAY",
}
# Kafka topic and options of the Kafka detector.
KAFKA_TOPIC = "ad-events"
KAFKA_BOOTSTRAP = "localhost:9092"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Flag rule F1: ``amount > max_amount OR rate > max_rate OR categories > max_categories``.

    SQL three-valued logic applies: a null rate (no views) never flags by itself.
    """

    max_amount: int = MAX_AMOUNT
    max_rate: float = MAX_RATE
    max_categories: int = MAX_CATEGORIES


@dataclass(frozen=True)
class WindowSpec:
    """Sliding event-time window and watermark."""

    duration: str = WINDOW_DURATION
    slide: str = SLIDE_DURATION
    watermark: str = WATERMARK_DELAY


# Window used on the test tables: events there are ~10k per 30 days at sf0.01,
# so 10 minute windows never cross a threshold. One day / 12 hours does.
DAILY = WindowSpec(duration="1 day", slide="12 hours", watermark=WATERMARK_DELAY)
