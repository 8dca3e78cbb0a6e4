"""End-to-end detector jobs (Q1-Q4) and a command line.

    python -m botsieve.plans.jobs detect --source Data/ --bots /shared/bots \
        [--checkpoint /shared/ckpt] [--no-lookup] [--ticks N] [--interval 60]
    python -m botsieve.plans.jobs detect --kafka localhost:9092 --topic ad-events ...

Q1: no lookup, flagged addresses written to the bot table.
Q2/Q3: lookup first (stream-static anti join with the bot table), then the
same. The per-row cache probe of Q3 is the same join: a closure per row is
opaque to the optimizer and costs a remote call per event.
Q4: the Kafka source parsed with the long epoch form (``kafka_events``).

One tick = one ``availableNow`` run on the checkpoint; every tick plans the
query anew, so the bot table written by earlier ticks is read fresh. A job
that never stops is a loop of ticks (``--ticks 0``).
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from botsieve.functions.parse import decode_value, parse_events, with_event_time
from botsieve.operators.committed import CommittedBots
from botsieve.params import BLOCK_TTL_HOURS, KAFKA_BOOTSTRAP, KAFKA_TOPIC, Thresholds, WindowSpec
from botsieve.session import get_session, shared_root
from botsieve.streaming.detector import (block_list_sink, bots_fresh, committed_sink, detect, kafka_stream,
                                         run_available_now, text_stream)


VACUUM_TICKS = 100    # ticks of a job between clean-ups of the commit-logged table


@dataclass
class DetectorJob:
    """Q1/Q2/Q3 as a restartable streaming job."""

    spark: SparkSession
    bots_path: str
    checkpoint: str
    source_dir: str | None = None
    kafka_servers: str | None = None
    kafka_topic: str = KAFKA_TOPIC
    spec: WindowSpec = field(default_factory=WindowSpec)
    thresholds: Thresholds = field(default_factory=Thresholds)
    lookup: bool = True
    # Entries expire this long after creation; an expired address can be
    # listed again. None keeps entries forever.
    ttl_hours: int | None = BLOCK_TTL_HOURS
    # "files": a folder of Parquet files, one writer. "commits": the
    # commit-logged table, for any number of jobs, expired and compacted as
    # it is written.
    list_format: str = "files"

    def lines(self) -> DataFrame:
        if self.kafka_servers:
            raw = kafka_stream(self.spark, self.kafka_servers, self.kafka_topic)
            return raw.select(decode_value("value").alias("value"))
        return text_stream(self.spark, self.source_dir)

    def now(self) -> datetime | None:
        return datetime.now(timezone.utc) if self.ttl_hours is not None else None

    def plan(self, as_of: datetime | None = None) -> DataFrame:
        bots = None
        if self.lookup:
            if self.list_format == "commits":
                bots = CommittedBots(self.spark, self.bots_path).read(as_of, self.ttl_hours or 0)
            else:
                bots = bots_fresh(self.spark, self.bots_path, as_of, self.ttl_hours or 0)
        return detect(self.lines(), self.spec, self.thresholds, bots=bots)

    def tick(self) -> None:
        as_of, ttl_hours = self.now(), self.ttl_hours or 0
        if self.list_format == "commits":
            sink = committed_sink(self.bots_path, self.checkpoint, created_at=as_of, as_of=as_of, ttl_hours=ttl_hours)
        else:
            sink = block_list_sink(self.bots_path, as_of=as_of, ttl_hours=ttl_hours)
        run_available_now(self.plan(as_of), self.checkpoint, "update", batch_fn=sink)

    def run(self, ticks: int = 1, interval: float = 60.0) -> None:
        """``ticks=0`` runs until stopped."""
        n = 0
        while ticks == 0 or n < ticks:
            started = time.monotonic()
            self.tick()
            if self.list_format == "commits" and n % VACUUM_TICKS == 0:
                CommittedBots(self.spark, self.bots_path).vacuum()
            n += 1
            if ticks == 0 or n < ticks:
                time.sleep(max(0.0, interval - (time.monotonic() - started)))


def kafka_events(spark: SparkSession, servers: str = KAFKA_BOOTSTRAP, topic: str = KAFKA_TOPIC) -> DataFrame:
    """Q4: Kafka values decoded and parsed, epoch seconds as a long, plus the
    event-time column the windows need."""
    raw = kafka_stream(spark, servers, topic)
    return with_event_time(parse_events(raw, "value", time_type="long"))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="botsieve.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("detect", help="window, flag and list bots")
    d.add_argument("--source", help="folder of raw event lines")
    d.add_argument("--kafka", help="bootstrap servers; read the topic instead of a folder")
    d.add_argument("--topic", default=KAFKA_TOPIC)
    d.add_argument("--bots", required=True, help="bot table folder (parquet)")
    d.add_argument("--list-format", choices=("files", "commits"), default="files", help="form of the bot table")
    d.add_argument("--checkpoint", help="checkpoint folder (default: below spark.checkpoint.dir)")
    d.add_argument("--no-lookup", action="store_true", help="Q1: do not drop listed addresses first")
    d.add_argument("--window", default=WindowSpec().duration)
    d.add_argument("--slide", default=WindowSpec().slide)
    d.add_argument("--watermark", default=WindowSpec().watermark)
    d.add_argument("--max-amount", type=int, default=Thresholds().max_amount)
    d.add_argument("--max-rate", type=float, default=Thresholds().max_rate)
    d.add_argument("--max-categories", type=int, default=Thresholds().max_categories)
    d.add_argument("--ticks", type=int, default=1, help="0 = run until stopped")
    d.add_argument("--interval", type=float, default=60.0, help="seconds between ticks")
    args = ap.parse_args(argv)
    if not (args.source or args.kafka):
        ap.error("give --source or --kafka")
    spark = get_session()
    job = DetectorJob(
        spark=spark, bots_path=args.bots,
        checkpoint=args.checkpoint or f"{shared_root(spark)}/detector-checkpoint",
        source_dir=args.source, kafka_servers=args.kafka, kafka_topic=args.topic,
        spec=WindowSpec(args.window, args.slide, args.watermark),
        thresholds=Thresholds(args.max_amount, args.max_rate, args.max_categories),
        lookup=not args.no_lookup, list_format=args.list_format)
    job.run(args.ticks, args.interval)


if __name__ == "__main__":
    main()
