"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in the words
it has; the document's score is the noisy-or of its sentences, ``1 - product(1
- p)``: one offending sentence is enough. Only documents carry labels; the
likelihood of the document labels is maximised over the word weights, by
gradient steps through the noisy-or, so the model itself finds the sentences
to blame. Those at or above ``BLAME`` are then located as spans.

Words are runs of letters and digits in lower case (A-Z). A word counts as
itself and as its beginnings of ``STEMS`` bytes, so that inflected forms share
weight; all are hashed to ``2**BITS`` places. A sentence ends at ``.``, ``!``,
``?`` or a line break. The model is fitted in one task on a bounded sample of
labelled rows (about ``SAMPLE`` of each class, and at most ``SAMPLE_BYTES`` of
text in all; documented parameters), and starts from smoothed log-odds of the documents that have a feature. Features
that are not clearly commoner in toxic documents (chi-square below ``CHI``) keep
weight zero. A feature counts once in a sentence. Scores are computed for every
whole text.

A score depends on the text alone. Defined results: null and empty texts have
no sentences and score 0; equal texts get equal scores; ids with several
labels count as toxic if one of them is; without both classes among the
labels (as in an empty table) every score is 0; a long text is read in blocks
and scored whole; other columns stay, but for one of the result's name, which it
replaces.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from .common import RUN_BYTES, batch_udf, fold, slices, struct_array, table, utf8
from .learn import Smallest, bounded, training_labels, with_labels

BITS = 17
NOTHING = 1 << BITS            # the place of a stem that a word is too short for
STEMS = (4, 5, 6)
SAMPLE, SAMPLE_BYTES = 2500, 64 << 20     # labelled rows per class, and bytes of their texts in all
CHI, PRIOR = 30.0, 10.0
START, PULL, RATE, ROUNDS = -6.0, 1e-5, 0.05, 300
FOLDS, HELD, REJECT, BLAME = 5, 0, 0.5, 0.5

# Bytes of words stay (A-Z in lower case), ends of sentences become line
# breaks, all others become spaces.
END, GAP = 0x0A, 0x20
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else
             END if b in b".!?\n" else GAP for b in range(256))
FOLD_ARRAY = np.frombuffer(FOLD, np.uint8)
BLOCK = 1 << 20     # bytes that are looked at at once
POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)


def word_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch: hashed places (one row for the words, one for each
    stem), sentence number, and byte bounds in the texts joined by single line
    breaks. Sentences are numbered through. Bytes are looked at in blocks that
    end between words, so what a long text needs grows with its words only."""
    joined = b"\n".join(texts) + b"\n"
    at, sentence, found = 0, 0, []
    while at < len(joined):
        end = min(at + BLOCK, len(joined))
        while FOLD[joined[end - 1]] > GAP:     # the last byte is a line break
            end += 1
        place, number, starts, stops, ends = block_places(np.frombuffer(joined, np.uint8, end - at, at))
        found.append((place, number + sentence, starts + at, stops + at))
        at, sentence = end, sentence + ends
    place, *rest = zip(*found)
    return np.concatenate(place, axis=1), *map(np.concatenate, rest)


def block_places(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``word_places`` of one block, and the ends of sentences in it."""
    data = FOLD_ARRAY[block]
    inside = np.concatenate(([False], data > GAP))
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = change[::2], change[1::2]
    ends = np.cumsum(data == END, dtype=np.int32)
    if not len(starts):
        return np.zeros((1 + len(STEMS), 0), np.int32), np.zeros(0, np.int32), starts, stops, int(ends[-1])
    # Hash of a word: its bytes times powers of a prime by their place in the
    # word (repeated every 64 bytes), summed.
    at = np.flatnonzero(data > GAP)
    word = np.repeat(np.arange(len(starts)), stops - starts)
    parts = (data[at].astype(np.uint64) + np.uint64(1)) * POWERS[(at - starts[word]) & 63]
    first = np.concatenate(([0], np.cumsum(stops - starts)[:-1]))
    places = [hashed(np.add.reduceat(parts, first), 0)]
    sums = np.concatenate((parts, np.zeros(max(STEMS), np.uint64))).cumsum()
    before = sums[first] - parts[first]
    for stem in STEMS:
        place = hashed(sums[first + stem - 1] - before, stem)
        place[stops - starts <= stem] = NOTHING
        places.append(place)
    return np.stack(places), ends[starts], starts, stops, int(ends[-1])


def hashed(code: np.ndarray, kind: int) -> np.ndarray:
    code = (code + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return ((code ^ code >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int32)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sentences_of(texts: list[bytes], weights: np.ndarray, bias: float):
    """Per sentence that has words: its text's number, its logit, byte bounds."""
    place, number, starts, stops = word_places(texts)
    if not place.size:
        return (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    # Once per sentence: only the few features with a weight are sorted.
    inside = np.cumsum(np.concatenate(([False], number[1:] != number[:-1])))
    stem, word = np.nonzero((weights != 0)[place])
    pairs = np.unique(inside[word] << (BITS + 1) | place[stem, word])
    logit = np.bincount(pairs >> (BITS + 1), weights[pairs & ((2 << BITS) - 1)], len(first)) + bias
    logit[np.bincount(pairs >> (BITS + 1), minlength=len(first)) == 0] = -np.inf
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    text = np.searchsorted(begin, starts[first], side="right") - 1
    last = np.concatenate((first[1:], [len(starts)])) - 1
    return text, logit, starts[first] - begin[text], stops[last] - begin[text]


def parts_of(texts: list[bytes], most: int = 1 << 20):
    """(number of the first text, texts) in runs of about ``most`` bytes."""
    first, run, size = 0, [], 0
    for i, data in enumerate(texts):
        if run and size + len(data) > most:
            yield first, run
            first, run, size = i, [], 0
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def fit(texts: list[bytes], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Word weights and bias that maximise the likelihood of the labels. Two
    passes over the texts: the first counts the documents of each feature, the
    second keeps the occurrences of the chosen features only."""
    counts = np.zeros((2, NOTHING + 1))
    for first, part in parts_of(texts):
        place, _, starts, _ = word_places(part)
        doc = np.searchsorted(np.cumsum([0, *(len(t) + 1 for t in part)]), starts, side="right") - 1
        pairs = np.unique((doc.astype(np.int64) << (BITS + 1) | place).ravel())
        of = y[first + (pairs >> (BITS + 1))].astype(int)
        for k in (0, 1):
            counts[k] += np.bincount(pairs[of == k] & ((2 << BITS) - 1), minlength=NOTHING + 1)
    (n0, n1), share = counts, y.mean()
    n, t1, t0 = n1 + n0, len(y) * share, len(y) * (1 - share)
    apart = (n1 * (t0 - n0) - n0 * (t1 - n1)) ** 2.0 * len(y)
    odds = (np.log((n1 + PRIOR * share) / (t1 + PRIOR * share))
            - np.log((n0 + PRIOR * (1 - share)) / (t0 + PRIOR * (1 - share))))
    kept = (apart >= CHI * np.maximum(n * (len(y) - n) * t1 * t0, 1)) & (odds > 0)
    kept[NOTHING] = False
    # Sentences with a kept feature: their features and their document.
    places, inside, owner = [], [], []
    for first, part in parts_of(texts):
        place, number, starts, _ = word_places(part)
        doc = np.searchsorted(np.cumsum([0, *(len(t) + 1 for t in part)]), starts, side="right") - 1
        stem, word = np.nonzero(kept[place])
        pairs = np.unique(number[word].astype(np.int64) << (BITS + 1) | place[stem, word])
        sentence, at = np.unique(pairs >> (BITS + 1), return_inverse=True)
        places.append(pairs & ((2 << BITS) - 1))
        inside.append(at + sum(map(len, owner)))
        owner.append(first + doc[np.searchsorted(number, sentence)])
    places, inside, owner = (np.concatenate(x) for x in (places, inside, owner))
    names, column = np.unique(places, return_inverse=True)
    theta = np.append(odds[names] / (1 + len(STEMS)), START)       # the bias is last
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    for step in range(1, ROUNDS + 1):
        z = np.bincount(inside, theta[column], len(owner)) + theta[-1]
        total = np.bincount(owner, softplus(z), len(texts))       # -log of no sentence
        miss = np.exp(-total)
        slope = weight * np.where(y > 0, -miss / np.maximum(1 - miss, 1e-9), 1.0)
        per = slope[owner] * sigmoid(z)
        grad = np.append(np.bincount(column, per[inside], len(names)), per.sum()) / len(texts)
        grad[:-1] += PULL * theta[:-1]
        mean = 0.9 * mean + 0.1 * grad
        spread = 0.999 * spread + 0.001 * grad * grad
        rate = RATE * (1 - (step - 1) / ROUNDS)
        theta -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(NOTHING + 1)
    weights[names] = theta[:-1]
    return weights, float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text",
          sample: int = SAMPLE):
    """(weights, bias) from a bounded sample, or None without both classes."""
    known = training_labels(labels, label, FOLDS, HELD, id_col, F.max)
    chosen = bounded(known, "label", sample, F.col("id"))

    def learn(batches):
        found = Smallest(SAMPLE_BYTES)
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                if data := t.as_py():
                    found.add(xxh64_digest(data) + bytes([y]), (data, y), len(data))
        rows = sorted(found.ordered())     # the same order at each run
        y = np.array([r[1] for r in rows], float)
        if len(np.unique(y)) == 2:
            weights, bias = fit([r[0] for r in rows], y)
            yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()]), pa.array([bias])],
                                             names=["weights", "bias"])

    rows = with_labels(docs, chosen, id_col, text).select(utf8("text").alias("text"), "label")
    model = rows.repartition(1).mapInArrow(learn, "weights binary, bias double").collect()
    return (np.frombuffer(model[0]["weights"], np.float32), model[0]["bias"]) if model else None


KINDS = [("score", pa.float64()), ("n_offending", pa.int64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
RESULT = "struct<score:double,n_offending:bigint,spans:array<struct<start:bigint,end:bigint,score:double>>>"


def toxicity_column(spark: SparkSession, model, text: str | Column) -> Column:
    """struct(score, n_offending, spans): spans are the offending sentences in
    code points, end exclusive, from their first word to their last."""
    if model is None:
        return F.lit(None).cast(RESULT)
    shared = spark.sparkContext.broadcast(model)

    def make():
        weights, bias = shared.value

        def run(texts):
            scores, counts, spans = [], [], []
            for part in slices(texts, RUN_BYTES, 4096):
                text, logit, a, b = sentences_of(part, weights, bias)
                scores += (1 - np.exp(-np.bincount(text, softplus(logit), len(part)))).tolist()
                found = [[] for _ in part]
                for i in np.flatnonzero(sigmoid(logit) >= BLAME):
                    data, start = part[text[i]], int(a[i])
                    # Code points, counted on from the span before.
                    at, points = found[text[i]][-1]["at"] if found[text[i]] else (0, 0)
                    points += count_points(data, at, start)
                    size = count_points(data, start, int(b[i]))
                    found[text[i]].append({"start": points, "end": points + size, "score": float(sigmoid(logit[i])),
                                           "at": (int(b[i]), points + size)})
                counts += [len(f) for f in found]
                spans += [[{k: s[k] for k in ("start", "end", "score")} for s in f] for f in found]
            return struct_array(KINDS, [scores, counts, spans])
        return run
    return batch_udf(make, RESULT)(utf8(text))


def count_points(data: bytes, a: int, b: int) -> int:
    """Code points of data[a:b]."""
    return len(data[a:b].decode("utf-8", "replace"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``out``, learned from ``labels``."""
    return docs.withColumn(out, toxicity_column(docs.sparkSession, train(docs, labels, "toxic", id_col, text), text))


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a score below ``REJECT``, unchanged."""
    column = toxicity_column(docs.sparkSession, train(docs, labels, "toxic", id_col, text), text)
    return docs.filter(F.coalesce(column["score"], F.lit(0.0)) < REJECT)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity(docs, table(spark, sf_dir, "labels")).withColumn("score", F.coalesce("toxicity.score", F.lit(0.0)))
    spans = F.transform("toxicity.spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                        (F.col("score") >= REJECT).cast("int").alias("predicted"),
                        F.concat_ws(",", spans).alias("offending"))
