"""Quality scores by naive Bayes support vectors.

*Features.* Presence of hashed n-grams: of bytes (orders 1 to 4), and of word
shapes (orders 1 to 3; a shape is how a word is written: case, digits, signs,
and which of the words shortly before it it repeats).

*Log-count ratios.* For each feature the log of the ratio of its smoothed
share among the good and among the bad labelled texts. The counts cover all
labelled training rows: tasks count their rows, and the sums are grouped by
feature (at most ``2 * 2**BITS`` rows reach the driver).

*Support vectors.* The indicators are scaled by the ratios, brought to length
one, and a linear hinge-loss model is fitted by dual coordinate descent on a
bounded sample (about ``SAMPLE`` rows per class, and at most ``SAMPLE_BYTES`` of
their features in all; documented parameters) in one task. Two more fits on the halves of the sample give out-of-sample
margins, by which a logistic curve turns margins into scores from 0 to 1.

A score depends on the text alone. Defined results: null and empty texts have
no features and get the score of margin = bias; equal texts get equal scores;
ids with several labels count as bad if one of them is; without both classes
among the labels (as in an empty table) every score is 0.5; a long text is
read in pieces and scored whole; other columns stay, but for one of the
result's name, which it replaces.
"""

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from .common import batch_udf, fold, slices, table, utf8
from .grams import Presence
from .learn import Smallest, bounded, training_labels, with_labels

BITS = 16                  # places of byte n-grams, and again of shape n-grams
ORDERS, SHAPE_ORDERS = (1, 2, 3, 4), (1, 2, 3)
SMOOTH = 1.0
SAMPLE = 2000              # rows per class that the hinge-loss model is fitted on,
SAMPLE_BYTES = 256 << 20   # and bytes of their places and values in all
COST, ROUNDS = 1.0, 30
FOLDS, HELD, KEEP = 5, 0, 0.3
BACK = 3                   # words back that a repeated word is looked for

# Classes of bytes in a word's shape.
SHAPE = bytes(ord("A") if 0x41 <= b <= 0x5A else ord("a") if 0x61 <= b <= 0x7A or b >= 0x80 else
              ord("0") if 0x30 <= b <= 0x39 else ord(",") if b in b".,;:!?'\"-()" else b for b in range(256))


SHAPE_ARRAY = np.frombuffer(SHAPE, np.uint8)


def shapes_of(data: bytes) -> list[bytes]:
    """The shape of each word: its classes with runs cut to one (``Aa``, ``a%``)."""
    classes = SHAPE_ARRAY[np.frombuffer(data, np.uint8)]
    first = np.ones(len(classes), bool)
    first[1:] = classes[1:] != classes[:-1]
    return classes[first].tobytes().split()


class Features:
    """Presence rows of a batch of texts: byte n-grams, then shape n-grams."""

    def __init__(self):
        self.grams = Presence(ORDERS, BITS)

    def mark_shapes(self, data: bytes, flags: np.ndarray) -> None:
        words = data.split()
        if not words:
            return
        codes = np.fromiter(map(crc32, shapes_of(data)), np.uint64, len(words))
        # Equal neighbours by their hash within this process.
        sames = np.fromiter(map(hash, words), np.int64, len(words))
        for back in range(1, min(BACK, len(words) - 1) + 1):
            codes[back:] += np.where(sames[back:] == sames[:-back], np.uint64(back << 32), np.uint64(0))
        mixed = codes * np.uint64(0x9E3779B97F4A7C15)
        run = mixed
        for n in SHAPE_ORDERS:
            if n > 1:
                run = (run[:-1] ^ run[:-1] >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) + mixed[n - 1:]
            if not len(run):
                break
            flags[(run * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)] = True

    def matrix(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), 2 << BITS), bool)
        for row, data in zip(out, texts):
            self.grams.mark(data, row[:1 << BITS])
            self.mark_shapes(data, row[1 << BITS:])
        return out


def log_ratios(n_good: np.ndarray, n_bad: np.ndarray) -> np.ndarray:
    p, q = n_good + SMOOTH, n_bad + SMOOTH
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray,
                 rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """Linear hinge-loss weights (the last one is the bias) by dual coordinate
    descent: one row's multiplier at a time moves to its optimum in [0, cost].
    ``rows``: places and values, each of length one; the bias adds a 1."""
    w, alpha, rng = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            slope = y[i] * (w[at] @ x + w[size]) - 1
            new = min(max(alpha[i] - slope / (x @ x + 1), 0.0), cost[i])
            if (step := (new - alpha[i]) * y[i]):
                w[at] += step * x
                w[size] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def logistic_fit(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of margins (a few Newton steps,
    with a small pull towards slope 2 and offset 0)."""
    theta = np.array([2.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - (y > 0))) + (theta - [2.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta -= step
        if abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 0.1), float(theta[1])


def scaled(flags: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(flags).astype(np.int32)
    values = ratios[at].astype(np.float32)
    return at, values / max(float(np.sqrt(values @ values)), 1e-12)


def fit(rows: list, y: np.ndarray, size: int) -> tuple[np.ndarray, float, float]:
    """Weights (bias last), slope and offset from scaled rows and labels +-1."""
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    cost = COST * 0.5 / share
    margins, half = np.zeros(len(rows)), np.arange(len(rows)) % 2
    for part in (0, 1):
        own, rest = np.flatnonzero(half == part), np.flatnonzero(half != part)
        if len(np.unique(y[rest])) < 2:
            rest = np.arange(len(rows))
        w = dual_descent([rows[i] for i in rest], y[rest], size, cost[rest])
        margins[own] = [w[rows[i][0]] @ rows[i][1] + w[size] for i in own]
    slope, offset = logistic_fit(margins, y, 0.5 / share)
    return dual_descent(rows, y, size, cost), slope, offset


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Labelled rows (text, label) that have each feature, by label 0 and 1."""
    size = 2 << BITS

    def count(batches):
        features, total = Features(), np.zeros((2, size), np.int64)
        for batch in batches:
            labels, at = batch.column(1).to_numpy(zero_copy_only=False), 0
            for texts in slices(batch.column(0)):
                x = features.matrix(texts)
                part = labels[at:at + len(texts)]
                for k in (0, 1):
                    total[k] += x[part == k].sum(axis=0)
                at += len(texts)
        found = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[0, found]),
                                          pa.array(total[1, found])], names=["feature", "n0", "n1"])

    counted = rows.select(utf8("text").alias("text"), "label").mapInArrow(count, "feature int, n0 bigint, n1 bigint")
    sums = counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    out = np.zeros((2, size))
    out[0, sums["feature"]], out[1, sums["feature"]] = sums["n0"], sums["n1"]
    return out[0], out[1]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text",
          sample: int = SAMPLE):
    """The model: (ratios, weights, slope, offset), or None without both classes."""
    spark = docs.sparkSession
    known = training_labels(labels, label, FOLDS, HELD, id_col, F.min).persist()
    classes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    rows = with_labels(docs, known, id_col, text)
    n0, n1 = feature_counts(rows)
    if len(classes) < 2 or not n0.any() or not n1.any():
        known.unpersist()
        return None
    ratios = log_ratios(n1, n0)
    shared = spark.sparkContext.broadcast(ratios.astype(np.float32))
    chosen = bounded(known, "label", sample, F.col("id"), classes)

    def learn(batches):
        features, ratios, found = Features(), shared.value.astype(float), Smallest(SAMPLE_BYTES)
        for batch in batches:
            texts, ys = batch.column(0), batch.column(1).to_pylist()
            done = 0
            for run in slices(texts):
                for data, flags, y in zip(run, features.matrix(run), ys[done:done + len(run)]):
                    row = scaled(flags, ratios)
                    # By text, then label: the same rows in the same order at each run.
                    found.add(xxh64_digest(data) + bytes([y]), (2 * y - 1, row), sum(x.nbytes for x in row))
                done += len(run)
        rows = found.ordered()
        y = np.array([f[0] for f in rows], float)
        if len(np.unique(y)) < 2:
            return
        w, slope, offset = fit([f[1] for f in rows], y, 2 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()]), pa.array([slope]), pa.array([offset])],
                                         names=["w", "slope", "offset"])

    model = (with_labels(docs, chosen, id_col, text).select(utf8("text").alias("text"), "label")
             .repartition(1).mapInArrow(learn, "w binary, slope double, offset double").collect())
    known.unpersist()
    if not model:
        return None
    return ratios, np.frombuffer(model[0]["w"]), model[0]["slope"], model[0]["offset"]


def score_column(spark: SparkSession, model, text: str | Column) -> Column:
    if model is None:
        return F.lit(0.5)
    ratios, w, slope, offset = model
    size = len(ratios)
    # Columns: weight of each indicator, and its part of the squared length.
    parts = np.stack([ratios * w[:size], ratios ** 2], 1)
    shared = spark.sparkContext.broadcast((parts, float(w[size]), slope, offset))

    def make():
        (parts, bias, slope, offset), features = shared.value, Features()

        def run(texts):
            sums = np.array([parts[np.flatnonzero(row)].sum(axis=0) for part in slices(texts)
                             for row in features.matrix(part)]).reshape(-1, 2)
            margin = sums[:, 0] / np.sqrt(np.maximum(sums[:, 1], 1e-12)) + bias
            return pa.array(1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30))), pa.float64())
        return run
    return batch_udf(make, "double")(utf8(text))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", out: str = "score",
          sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a quality score column ``out``, learned from ``labels``."""
    model = train(docs, labels, "quality", id_col, text, sample)
    return docs.withColumn(out, score_column(docs.sparkSession, model, text))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                         (F.col("score") >= KEEP).cast("int").alias("predicted"))
