"""F2/Q3 against keyed state: an address stops counting at the event that lists it.

The round-based jobs read the block list when a round is planned, so an address
counts on until the round ends. Here the list itself is state, keyed by address
(``transformWithState``): each event first meets the address's own entry, as a
probe of a keyed cache would, and the entry is there from the event that made it.

*Semantics.* An address counts in its windows. At the first event (by time, kind
and category) at which any window crosses a threshold it is listed, with the
latest end of the windows that cross there, and its entry lives ``ttl`` from
that event's time. Windows that began before an entry expires do not count;
later ones start afresh, and the address may be listed again.

*State.* A window needs its ``max_amount + 1`` earliest events at most, because
the last of them crosses the amount. Windows are made of whole steps (the common
divisor of duration and slide), so that many events of each step are enough for
all of them: an address is one short list however often it sends, input is taken
in any order, and a batch may hold any number of events of one address.

*Cost.* Python reaches the state by one request and answer after the other, so a
batch costs an address a read, a write and the move of its one timer, whatever
the number of its windows. Windows that the watermark has passed go when the
address sends again, or by that timer when all of them are past.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from collections.abc import Iterator
from math import gcd

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from botsieve.functions.features import ADDRESS, CATEGORY, KIND, TIME
from botsieve.params import CLICK, VIEW, Thresholds, WindowSpec

LISTINGS = f"{ADDRESS} string, end_micros bigint, listed_micros bigint"
EVENTS = "events"
#: An event is its time and a code (bits 40, 41: the kind; 32: whether there is a
#: category; 0 to 31: the category), so clicks of one time come before its views.
RECORD = struct.Struct(">qq")
CLICKED, VIEWED = 0, 2
#: So many rows at most are gathered by address at once.
GATHERED = 1 << 19


def event_code() -> Column:
    kind = F.when(F.col(KIND) == CLICK, CLICKED).when(F.col(KIND) == VIEW, VIEWED).otherwise(1)
    known = F.shiftleft(F.lit(1).cast("bigint"), 32).bitwiseOR(F.col(CATEGORY).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.shiftleft(kind.cast("bigint"), 40).bitwiseOR(F.coalesce(known, F.lit(0).cast("bigint")))


def crossing(events: list, thresholds: Thresholds) -> int | None:
    """The time at which events (time, code), in order, first cross a threshold."""
    clicks = views = 0
    categories = set()
    for amount, (at, code) in enumerate(events, 1):
        clicks, views = clicks + (code >> 40 == CLICKED), views + (code >> 40 == VIEWED)
        if code >> 32 & 1:
            categories.add(code & 0xFFFFFFFF)
        if (amount > thresholds.max_amount or views and clicks / views > thresholds.max_rate
                or len(categories) > thresholds.max_categories):
            return at
    return None


class ListedAddresses(StatefulProcessor):
    """Times are microseconds since the epoch."""

    def __init__(self, duration: int, slide: int, ttl: int, thresholds: Thresholds):
        self.duration, self.slide, self.ttl, self.thresholds = duration, slide, ttl, thresholds
        self.step, self.most = gcd(duration, slide), thresholds.max_amount + 1
        # So few events cross nothing: one view at least goes into a rate.
        self.quiet = min(thresholds.max_amount, thresholds.max_categories, thresholds.max_rate + 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # An entry lies with the events of its address, or alone if there are none.
        self.until = handle.getValueState("until", "micros bigint")
        self.windows = handle.getValueState("windows", f"until bigint, {EVENTS} binary")

    def last_end(self, micros: int) -> int:
        """The end of the last window that an event of this time is in."""
        return micros // self.slide * self.slide + self.duration

    def timer(self, until: int | None, events: list) -> int | None:
        """The milliseconds at which nothing of an address is needed any more: an
        entry is kept as long as a window that began before its end can get events."""
        ends = [until + self.duration] if until is not None else []
        if events:
            ends.append(self.last_end(events[-1][0]))
        return -(-max(ends) // 1000) if ends else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        until, held = None, []
        if stored := self.windows.get():
            until, held = stored[0], list(RECORD.iter_unpack(stored[1]))
        elif alone := self.until.get():
            until = alone[0]
        entry_alone, before = until is not None and not held, self.timer(until, held)
        steps, new = {}, set()
        for event in held:
            steps.setdefault(event[0] // self.step, []).append(event)
        for row in rows:
            for event in RECORD.iter_unpack(row[EVENTS]):
                step = event[0] // self.step
                events = steps.setdefault(step, [])
                if len(events) < self.most or event < events[-1]:
                    insort(events, event)
                    del events[self.most:]
                    new.add(step)
        held = [event for step in sorted(steps) for event in steps[step]]
        found = {}
        for start in {start for step in new for start in self.starts(step * self.step)}:
            if until is None or start >= until:
                low, high = bisect_left(held, (start,)), bisect_left(held, (start + self.duration,))
                if high - low > self.quiet and (at := crossing(held[low:high][:self.most], self.thresholds)) is not None:
                    found[start] = at
        while found:
            at = min(found.values())
            end = max(s for s in found if found[s] == at) + self.duration
            yield Row(**{ADDRESS: key[0], "end_micros": end, "listed_micros": at})
            until = at + self.ttl
            found = {s: at for s, at in found.items() if s >= until}
        now = timerValues.getCurrentWatermarkInMs() * 1000
        if until is not None and until + self.duration <= now:
            until = None
        held = [e for e in held if self.last_end(e[0]) > now and (until is None or self.last_end(e[0]) >= until + self.duration)]
        self.keep(stored, entry_alone, until, held)
        if (after := self.timer(until, held)) != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)

    def starts(self, micros: int) -> range:
        """The starts of all windows that an event of this time is in."""
        return range(micros // self.slide * self.slide, micros - self.duration, -self.slide)

    def keep(self, stored, entry_alone: bool, until: int | None, held: list) -> None:
        if held:
            self.windows.update((until, b"".join(RECORD.pack(*e) for e in held)))
        elif stored:
            self.windows.clear()
        if until is not None and not held:
            self.until.update((until,))
        elif entry_alone:
            self.until.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.windows.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def micros_of(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {interval})").first()[0]


def gather(batches: Iterator) -> Iterator:
    """Arrow batches (address, micros, code) -> (address, events): an address's
    events are one row as far as they are among ``GATHERED`` rows."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def gathered(held: list):
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.take(pc.sort_indices(table, [(ADDRESS, "ascending")]))
        address = table.column(ADDRESS).combine_chunks()
        records = np.column_stack([table.column(c).to_numpy() for c in ("micros", "code")]).astype(">i8")
        other = pc.fill_null(pc.not_equal(address[1:], address[:-1]), True)
        first = np.flatnonzero(np.concatenate([[True], other.to_numpy(zero_copy_only=False)]))
        offsets = np.append(first, len(records)).astype("int32") * RECORD.size
        events = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])
        return pa.RecordBatch.from_arrays([address.take(pa.array(first)), events], names=[ADDRESS, EVENTS])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= GATHERED:
            yield gathered(held)
            held, size = [], 0
    if held:
        yield gathered(held)


def listings(events: DataFrame, spec: WindowSpec, thresholds: Thresholds, ttl_hours: float, in_order: bool = False) -> DataFrame:
    """(address, end, listed_at) for every listing, from a stream of events.

    ``in_order``: every batch is later than the ones before it, so no row comes too
    late. The events of an address then go to its state as a row, and the
    watermark, which only clears state then, drops none of them."""
    spark = events.sparkSession
    processor = ListedAddresses(micros_of(spark, spec.duration), micros_of(spark, spec.slide), int(ttl_hours * 3_600_000_000), thresholds)
    rows = events.withWatermark(TIME, spec.watermark).withColumns({"micros": F.unix_micros(TIME), "code": event_code()})
    if in_order:
        rows = rows.select(ADDRESS, "micros", "code").repartition(ADDRESS).mapInArrow(gather, f"{ADDRESS} string, {EVENTS} binary")
    else:
        hexed = F.concat(*(F.lpad(F.hex(c), 16, "0") for c in ("micros", "code")))
        rows = rows.select(ADDRESS, TIME, F.unhex(hexed).alias(EVENTS))
    found = rows.groupBy(ADDRESS).transformWithState(processor, LISTINGS, "append", "eventTime")
    return found.select(ADDRESS, F.timestamp_micros("end_micros").alias("end"), F.timestamp_micros("listed_micros").alias("listed_at"))
