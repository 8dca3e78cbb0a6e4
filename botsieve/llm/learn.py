"""Labels, folds and bounded samples for the classifiers."""

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold

SMALL = 2_000_000   # rows of (id, label) that may be broadcast: below 100 MB
SPAN = 1 << 31


def training_labels(labels: DataFrame, label: str, parts: int, held: int, id_col: str = "doc_id",
                    worst=F.max) -> DataFrame:
    """(id, label 0/1) of the labelled ids outside the held-out fold, one row
    per id: null labels and ids are left out, and an id with several labels
    takes ``worst`` of them."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").filter(fold("id", parts) != held)
    return known.groupBy("id").agg(worst("label").alias("label"))


def bounded(df: DataFrame, kind: str, per_class: int, key: Column, classes: dict | None = None) -> DataFrame:
    """A sample of about ``per_class`` rows of each class, by a hash of ``key``
    (the same rows at each run). ``classes``: counts, if already known."""
    counts = classes or {r[0]: r[1] for r in df.groupBy(kind).count().collect()}
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(SPAN))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | (F.col(kind).eqNullSafe(F.lit(value)) & (place < int(SPAN * min(1.0, per_class / n))))
    return df.filter(keep)


def with_labels(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, label) of the documents with a label. The labels go to the
    documents by broadcast if their count allows it; otherwise both sides are
    shuffled by id (ids are near unique, so no task gets a large share)."""
    pairs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return pairs.join(F.broadcast(known) if known.count() <= SMALL else known, "id")


class Smallest:
    """Rows of the smallest digests whose sizes sum up to at most ``most`` bytes
    (one row at least): the same rows in whatever order they come, and never
    more than that held. A sample of rows is bounded in bytes by it."""

    def __init__(self, most: int):
        self.most, self.size, self.rows, self.seen = most, 0, [], 0
        self.limit = -float("inf")     # the smallest digest that had to go, negated

    def add(self, digest: bytes, row, size: int) -> None:
        key = -int.from_bytes(digest, "big")
        if key <= self.limit:
            return
        self.seen += 1      # tells rows of one digest apart; they are alike
        heapq.heappush(self.rows, (key, self.seen, size, row))
        self.size += size
        while self.size > self.most and len(self.rows) > 1:
            self.limit, _, gone, _ = heapq.heappop(self.rows)
            self.size -= gone
            while len(self.rows) > 1 and self.rows[0][0] == self.limit:    # its copies go with it
                self.size -= heapq.heappop(self.rows)[2]

    def ordered(self) -> list:
        return [row for *_, row in sorted(self.rows, key=lambda r: (-r[0], r[1]))]
