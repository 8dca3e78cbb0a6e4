"""P16/K6 on a stream: events and dead letters out of one pass.

Each line is groomed and parsed once and goes out as one row of one of three
kinds: ``event``, ``corrupt`` (an object the JSON reader rejects) or
``incomplete`` (no object, or one without time or address). All kinds are
written by one query through the file sink, partitioned by kind; its log of
batches makes each batch visible once, so a replay changes neither output. The
windows read the events as a stream of their own (the file source follows the
same log); the dead letters are a table to look at and to feed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.functions.features import ADDRESS
from botsieve.functions.parse import CORRUPT_COLUMN, decode_value, event_schema, groom, parsed_once
from botsieve.operators.windows import window_features
from botsieve.params import EVENT_COLUMNS, JSON_FIELDS, WindowSpec
from botsieve.streaming.detector import default_state_partitions, last_values, run_available_now, text_stream, versioned_sink

EVENT, CORRUPT, INCOMPLETE = "event", "corrupt", "incomplete"


def split_lines(lines: DataFrame, value_col: str = "value", time_type: str = "timestamp") -> DataFrame:
    """(line, object, the event's columns, kind) for every line."""
    schema = event_schema(time_type, corrupt_column=CORRUPT_COLUMN)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    groomed = lines.select(decode_value(value_col).alias("line"), groom(value_col).alias("object"))
    row = F.struct("line", "object", F.from_json("object", schema, options).alias("parsed"))
    rows = parsed_once(groomed, row, "r").select("r.line", "r.object", "r.parsed")
    bad = (F.col("object") != "") & F.col(f"parsed.{CORRUPT_COLUMN}").isNotNull()
    columns = [F.col(f"parsed.{a}").alias(b) for a, b in zip(JSON_FIELDS, EVENT_COLUMNS)]
    whole = F.col(f"parsed.{JSON_FIELDS[0]}").isNotNull() & F.col(f"parsed.{JSON_FIELDS[2]}").isNotNull()
    # A readable event stays one, also if another of its fields was not.
    kind = F.when(whole, EVENT).when(bad, CORRUPT).otherwise(INCOMPLETE)
    return rows.select("line", "object", *columns, kind.alias("kind"))


class TeeJob:
    """Lines in ``feed`` -> events with their windows, and dead letters."""

    def __init__(self, spark: SparkSession, feed: str, root: str, spec: WindowSpec, state_partitions: int | None = None):
        self.spark, self.feed, self.root, self.spec = spark, feed, root, spec
        self.partitions = state_partitions or default_state_partitions(spark)

    def split(self) -> None:
        rows = split_lines(text_stream(self.spark, self.feed))
        writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{self.root}/split").partitionBy("kind")
        query = writer.format("parquet").option("path", f"{self.root}/rows").trigger(availableNow=True).start()
        query.awaitTermination()

    def aggregate(self) -> None:
        schema = self.spark.read.parquet(f"{self.root}/rows").schema
        events = self.spark.readStream.schema(schema).parquet(f"{self.root}/rows").where(F.col("kind") == EVENT)
        features = window_features(events.select(*EVENT_COLUMNS), self.spec, distinct_mode="set", watermark=True)
        run_available_now(features, f"{self.root}/windows", "update", batch_fn=versioned_sink(f"{self.root}/updates"),
                          state_partitions=self.partitions)

    def run(self) -> None:
        self.split()
        self.aggregate()

    def windows(self) -> DataFrame:
        return last_values(self.spark.read.parquet(f"{self.root}/updates"), ["window", ADDRESS])

    def events(self) -> DataFrame:
        return self._rows(EVENT).select(*EVENT_COLUMNS)

    def dead_letters(self, kind: str = CORRUPT) -> DataFrame:
        """Lines of a kind as they came, and the groomed object (``value``)."""
        return self._rows(kind).select("line", F.col("object").alias("value"))

    def _rows(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows").where(F.col("kind") == kind)
