"""Language identification with a string kernel.

*Kernel.* Two texts are compared by the n-grams they share: the blended
spectrum of byte n-grams (orders 1 to 4) of the lower-cased letters, as
presence, ``|A and B| / sqrt(|A| |B|)``. N-grams are hashed to ``2**BITS``
places.

*Nyström landmarks.* About ``LANDMARKS`` training texts of each language
stand for all: a text's features are its kernel values to the landmarks, times
the inverse square root of the landmarks' own kernel matrix.

*One-versus-rest kernel ridge regression.* In landmark features this is a
linear ridge regression with one target per language. Tasks sum their part of
the normal equations over a bounded sample (about ``SAMPLE`` texts per
language, a documented parameter); the driver adds at most ``PARTS`` such sums
and solves a system of the size of the landmarks.

*Scoring.* Values to the landmarks are a matrix product of presence rows with
the landmarks' rows, and scores a product of those with the solved
coefficients. The two constant factors are multiplied once, so a batch of
texts takes one product (places x languages).

``lang_pred`` is the language of the largest value, ``score`` its share of the
positive values. Defined results: null texts and texts without a letter are
``und`` with score 0; ties go to the first language in order; without training
rows everything is ``und``. A prediction depends on the text alone.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_udf, fold, slices, struct_array, table, utf8, written
from .grams import Presence
from .learn import bounded

BITS, ORDERS = 15, (1, 2, 3, 4)
LANDMARKS, SAMPLE = 64, 2000     # per language
MOST = 512                       # landmarks in all, shared evenly among many languages
RIDGE, FLOOR = 1e-3, 1e-6        # of the mean diagonal; smallest eigenvalue kept
PARTS = 8
FOLDS, HELD, NONE = 4, 2, "und"

# A-Z in lower case; other ASCII characters than letters become spaces.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


GAPS, ASCII_LETTER = re.compile(b"  +"), re.compile(b"[a-z]")


def letters(data: bytes) -> bytes:
    return b" " + GAPS.sub(b" ", data.translate(FOLD)).strip(b" ") + b" "


def has_letter(data: bytes) -> bool:
    folded = data.translate(FOLD)
    return ASCII_LETTER.search(folded) is not None or any(map(str.isalpha, folded.decode("utf-8", "replace")))


def presence(texts: list[bytes], grams: Presence) -> np.ndarray:
    return grams.matrix([letters(t) for t in texts]).astype(np.float32)


def length(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def training_rows(docs: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    return rows.filter(F.col("lang").isNotNull() & (fold("id", FOLDS) != HELD))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          landmarks: int = LANDMARKS, sample: int = SAMPLE):
    """The model: (languages, places x languages), or None without training rows."""
    spark, rows = docs.sparkSession, training_rows(docs, id_col, text, lang)
    counts = {r[0]: r[1] for r in rows.select("lang").groupBy("lang").count().collect()}
    if not counts:
        return None
    names = sorted(counts)
    rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    # The texts are scanned once; landmarks are taken from the sample.
    chosen = written(bounded(rows, "lang", sample, key, counts).select("id", utf8("text").alias("text"), "lang"), "sample")

    def pack(batches):
        grams = Presence(ORDERS, BITS)
        for batch in batches:
            packed = [np.packbits(row).tobytes() for part in slices(batch.column(0))
                      for row in grams.matrix([letters(t) for t in part])]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["row"])

    landmarks = max(1, min(landmarks, MOST // len(names)))
    marked = bounded(chosen, "lang", landmarks, F.concat(key, F.lit(" landmark")))
    marks = marked.select("text").mapInArrow(pack, "row binary").distinct().collect()
    if not marks:
        return None
    packed = sorted(bytes(r["row"]) for r in marks)
    shared = spark.sparkContext.broadcast((packed, names))

    def unpack(packed):
        z = np.stack([np.unpackbits(np.frombuffer(p, np.uint8)) for p in packed]).astype(np.float32)
        return z / length(z)

    z = unpack(packed)
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    values = np.maximum(values, FLOOR)
    root = (vectors / np.sqrt(values)) @ vectors.T     # K_mm to the power -1/2

    def sums(batches):
        packed, names = shared.value
        z, grams, place = unpack(packed), Presence(ORDERS, BITS), {n: i for i, n in enumerate(names)}
        a, b, n = np.zeros((len(z), len(z))), np.zeros((len(z), len(names))), 0
        for batch in batches:
            langs, at = batch.column(1).to_pylist(), 0
            for part in slices(batch.column(0)):
                x = presence(part, grams)
                k = ((x / length(x)) @ z.T).astype(float)
                y = np.zeros((len(part), len(names)))
                y[np.arange(len(part)), [place[v] for v in langs[at:at + len(part)]]] = 1
                a, b, n, at = a + k.T @ k, b + k.T @ y, n + len(part), at + len(part)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()]), pa.array([n])],
                                         names=["a", "b", "n"])

    # Dealt by row, so that copies of one text are spread; the sums are the same.
    dealt = chosen.withColumn("n", F.monotonically_increasing_id()).repartition(PARTS, "n").select("text", "lang")
    parts = dealt.mapInArrow(sums, "a binary, b binary, n bigint").collect()
    a = sum(np.frombuffer(p["a"]).reshape(len(z), len(z)) for p in parts)
    b = sum(np.frombuffer(p["b"]).reshape(len(z), len(names)) for p in parts)
    a, b = root @ a @ root, root @ b
    ridge = RIDGE * max(np.trace(a) / len(a), 1e-12)
    solved = root @ np.linalg.solve(a + ridge * np.eye(len(a)), b)
    return names, (z.T.astype(float) @ solved).astype(np.float32)


def predict_column(spark: SparkSession, model, text: str | Column) -> Column:
    """struct(lang_pred, score) of a text column."""
    kinds = [("lang_pred", pa.string()), ("score", pa.float64())]
    if model is None:
        return F.struct(F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    def make():
        (names, weights), grams = shared.value, Presence(ORDERS, BITS)

        def run(texts):
            langs, scores = [], []
            for part in slices(texts):
                x = presence(part, grams)
                values = np.maximum((x @ weights) / length(x), 0).astype(float)
                total = np.maximum(values.sum(axis=1), 1e-12)
                for data, best, row, whole in zip(part, values.argmax(axis=1), values, total):
                    known = has_letter(data)
                    langs.append(names[best] if known else NONE)
                    scores.append(float(row[best] / whole) if known else 0.0)
            return struct_array(kinds, [langs, scores])
        return run
    return batch_udf(make, "lang_pred string, score double")(utf8(text))


def identify(docs: DataFrame, training: DataFrame | None = None, id_col: str = "doc_id", text: str = "text",
             lang: str = "lang", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` (lang_pred, score), learned from
    the languages of ``training`` (by default of ``docs`` itself)."""
    model = train(docs if training is None else training, id_col, text, lang)
    return docs.withColumn(out, predict_column(docs.sparkSession, model, text))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs)
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "language.lang_pred", "language.score")
