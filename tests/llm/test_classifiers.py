"""Quality, toxicity and language: held-out accuracy, folds and edge cases."""

import random
import zlib

import numpy as np
import pytest
from conftest import SF001
from llm_cases import edge_docs, edge_rows, no_docs, save
from pyspark.sql import functions as F

from botsieve.llm import langid, quality, toxicity
from botsieve.llm.grams import Presence

LABELS = "doc_id bigint, quality int, toxic int, text string"


def labels_of(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}


def crc(value):
    return zlib.crc32(str(value).encode())


def test_quality_held_out(spark):
    labels, rows = labels_of(spark), quality.op2(spark, SF001).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id].quality, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_toxicity_held_out_and_spans(spark):
    labels, rows = labels_of(spark), toxicity.op8(spark, SF001).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id].toxic, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.93
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in rows:
        spans = [tuple(map(int, s.split(":"))) for s in r.offending.split(",") if s]
        assert all(0 <= a < b <= len(texts[r.doc_id]) for a, b in spans)
        assert not spans or r.score >= toxicity.BLAME     # one offending sentence is enough


def test_language_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = langid.op10(spark, SF001).collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in rows if r.held_out]) >= 0.98


def test_labels_of_the_held_out_fold_do_not_matter(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(300).cache()
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    flip = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality",
                             "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = save(tmp_path / "a", documents=docs, labels=labels), save(tmp_path / "b", documents=docs, labels=flip)
    for query in (quality.op2, toxicity.op8):
        assert sorted(query(spark, one).collect()) == sorted(query(spark, two).collect())


@pytest.mark.parametrize("query, columns", [(quality.op2, ["score", "predicted"]), (toxicity.op8, ["score", "predicted"]),
                                            (langid.op10, ["lang_pred", "score"])])
def test_edge_cases(spark, tmp_path, query, columns):
    # Learned from the table's rows; judged on the edge cases among them.
    docs = edge_docs(spark)
    more = spark.read.parquet(f"{SF001}/documents.parquet").limit(200).selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").selectExpr("doc_id + 1000 AS doc_id", "quality", "toxic", "'clash' AS text")
    odd = spark.createDataFrame([(None, 1, 1, None), (0, None, None, None), (1, 1, 0, ""), (1, 0, 0, ""), (77, 1, 1, "")], LABELS)
    folder = save(tmp_path, documents=docs.unionByName(more, allowMissingColumns=True), labels=labels.unionByName(odd).unionByName(odd))
    rows = [r for r in query(spark, folder).collect() if r.doc_id is None or r.doc_id < 1000]
    assert len(rows) == len(edge_rows())
    assert len({tuple(r[c] for c in columns) for r in rows if r.doc_id in (0, 1)}) == 1       # equal texts
    assert len({tuple(r[c] for c in columns) for r in rows if r.doc_id in (3, 4)}) == 1       # null is empty
    assert all(0 <= r.score <= 1 for r in rows)
    if query is langid.op10:
        und = {r.doc_id for r in rows if r.lang_pred == "und"}
        assert {3, 4, 5, 7, 11} <= und and not und & {0, 1, 2, 8, 9, 10}
        assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    # Nothing to learn from, nothing to judge.
    none = save(tmp_path / "none", documents=no_docs(spark), labels=labels.limit(0))
    assert query(spark, none).count() == 0
    blank = save(tmp_path / "blank", documents=docs.withColumn("lang", F.lit(None).cast("string")),
                 labels=labels.limit(0))
    rows = query(spark, blank).collect()
    assert len(rows) == len(edge_rows())
    if query is langid.op10:
        assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    else:
        assert {r.score for r in rows} == {0.5 if query is quality.op2 else 0.0}


def test_dual_descent_separates():
    """Against the optimality conditions of the dual problem."""
    rnd = np.random.default_rng(1)
    rows, y = [], np.where(np.arange(60) % 3 == 0, 1.0, -1.0)
    for label in y:
        x = rnd.normal(size=6) + label
        rows.append((np.arange(6), x / np.linalg.norm(x)))
    cost = np.full(60, 1.0)
    w = quality.dual_descent(rows, y, 6, cost, rounds=3000)
    x = np.array([np.append(v, 1.0) for _, v in rows])
    value = lambda v: 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(value(w) <= value(w + d) + 1e-4 for d in rnd.normal(size=(300, 7)) * 0.05)


def test_presence_in_pieces(monkeypatch):
    import botsieve.llm.grams as grams
    text = bytes(random.Random(1).choice(b"abc ") for _ in range(3000))
    whole = Presence((1, 2, 3, 4), 15).ids(text)
    monkeypatch.setattr(grams, "PIECE", 50)
    assert (Presence((1, 2, 3, 4), 15).ids(text) == whole).all()
    assert len(Presence((1, 2), 15).ids(b"")) == 0 and len(Presence((1, 2, 3, 4), 15).ids(b"a")) == 1


def test_words_in_blocks(monkeypatch):
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"abAB .!?\n-\xc3\xa9") for _ in range(rnd.randrange(300))) for _ in range(100)] + [b"", b"a" * 500]
    whole = toxicity.word_places(texts)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, toxicity.word_places(texts)))


def test_noisy_or_by_hand():
    """Document score from sentence scores; hashing is that of single words."""
    weights = np.zeros(toxicity.NOTHING + 1)
    place, *_ = toxicity.word_places([b"bad"])
    weights[place[0, 0]] = 6.0
    text, logit, a, b = toxicity.sentences_of([b"a bad day. Good day! BAD, bad\nend", b"", b"bad"], weights, -5.0)
    assert text.tolist() == [0, 0, 0, 0, 2] and logit.tolist() == [1.0, -np.inf, 1.0, -np.inf, 1.0]
    assert [(int(x), int(y)) for x, y in zip(a, b)] == [(0, 9), (11, 19), (21, 29), (30, 33), (0, 3)]
    score = 1 - np.exp(-np.bincount(text, toxicity.softplus(logit), 3))
    p = 1 / (1 + np.exp(-1.0))
    assert np.allclose(score, [1 - (1 - p) ** 2, 0, p])


def test_long_label_lists_are_shuffled(spark, tmp_path, monkeypatch):
    """Labels beyond the broadcast bound give the same scores."""
    folder = save(tmp_path, documents=spark.read.parquet(f"{SF001}/documents.parquet").limit(300),
                  labels=spark.read.parquet(f"{SF001}/labels.parquet"))
    first = [sorted(query(spark, folder).collect()) for query in (quality.op2, toxicity.op8)]
    monkeypatch.setattr("botsieve.llm.learn.SMALL", -1)
    assert [sorted(query(spark, folder).collect()) for query in (quality.op2, toxicity.op8)] == first


def test_samples_are_bounded_and_stable(spark):
    rows = spark.range(30_000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    from botsieve.llm.learn import bounded
    some = bounded(rows, "label", 1000, F.col("id"))
    counts = {r.label: r["count"] for r in some.groupBy("label").count().collect()}
    assert all(850 <= n <= 1150 for n in counts.values()) and len(counts) == 2
    assert sorted(some.collect()) == sorted(bounded(rows.repartition(7), "label", 1000, F.col("id")).collect())
    assert bounded(rows, "label", 10**9, F.col("id")).count() == 30_000


def test_samples_are_bounded_in_bytes():
    """The rows of the smallest digests that fit, whatever their order; never more held."""
    from botsieve.llm.learn import Smallest
    rnd = random.Random(3)
    rows = [(rnd.randbytes(9), rnd.randrange(1, 400)) for _ in range(500)]
    rows += rows[:50]
    want, copies = [], {d: [x for x in rows if x[0] == d] for d, _ in rows}
    for d in sorted(copies):
        if want and sum(x for _, x in want) + sum(x for _, x in copies[d]) > 5000:
            break
        want += copies[d]
    for _ in range(5):
        rnd.shuffle(rows)
        held = Smallest(5000)
        for d, n in rows:
            held.add(d, (d, n), n)
            assert held.size <= 5000 and held.size == sum(r[2] for r in held.rows)
        assert held.ordered() == want
    one = Smallest(10)
    one.add(b"b", "long", 1000)
    assert one.ordered() == ["long"]


def test_long_texts_in_the_sample(spark, tmp_path, monkeypatch):
    """A few labelled texts of megabytes do not grow the fit, and it still learns."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    long = docs.join(labels, "doc_id").limit(8).select((F.col("doc_id") + 5000).alias("doc_id"), F.expr("repeat(concat(text, ' '), 400)").alias("text"), "quality", "toxic")
    folder = save(tmp_path, documents=docs.unionByName(long.select("doc_id", "text")), labels=labels.unionByName(long.select("doc_id", "quality", "toxic")))
    known = labels_of(spark)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 8 << 20)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 600_000)
    for query, label in ((quality.op2, "quality"), (toxicity.op8, "toxic")):
        held = [(known[r.doc_id][label], r.predicted) for r in query(spark, folder).collect() if r.held_out and r.doc_id in known]
        assert np.mean([a == b for a, b in held]) >= 0.85


def test_quality_model_against_dense_gradients(spark):
    """Ratios by counting, weights by full-batch gradient steps on the hinge loss
    of dense rows: the same margins on a small corpus."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(150)
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    ratios, w, *_ = quality.train(docs, labels)
    rows = [(r.text.encode(), r.quality) for r in docs.join(labels, "doc_id").collect() if crc(r.doc_id) % 5]
    x = quality.Features().matrix([t for t, _ in rows])
    y = np.array([2 * q - 1 for _, q in rows], float)
    good, bad = 1 + x[y > 0].sum(axis=0), 1 + x[y < 0].sum(axis=0)
    assert np.allclose(ratios, np.log(good / good.sum()) - np.log(bad / bad.sum()))
    z = x * ratios
    z = np.hstack([z / np.linalg.norm(z, axis=1, keepdims=True), np.ones((len(y), 1))])
    cost = 0.5 / np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    value = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (z @ v))).sum()
    v, best = np.zeros(z.shape[1]), np.inf
    for step in range(1, 4001):
        v -= (v - z.T @ (cost * y * (y * (z @ v) < 1))) / (10 + step)
        best = min(best, value(v))
    assert value(w) <= best * 1.02
    assert np.corrcoef(z @ w, z @ v)[0, 1] > 0.99


def test_toxicity_fit_against_a_grid(monkeypatch):
    """With one offending word the fit ends where a grid over its weight has the
    greatest likelihood of the noisy-or."""
    rnd = random.Random(5)
    sentence = lambda bad: " ".join(rnd.choice(["calm", "walk", "tree", "lake"]) for _ in range(4)) + (" vile" if bad else "")
    texts, y = [], []
    for i in range(160):
        flags = [rnd.random() < (0.3 if i % 2 else 0) for _ in range(rnd.randrange(1, 5))]
        texts.append(". ".join(sentence(f) for f in flags).encode())
        y.append(float(any(flags) if rnd.random() < 0.95 else not any(flags)))
    y = np.array(y)
    monkeypatch.setattr(toxicity, "ROUNDS", 1500)
    weights, bias = toxicity.fit(texts, y)
    place, *_ = toxicity.word_places([b"vile"])
    names = np.flatnonzero(weights)
    assert place[0, 0] in names
    # A sentence without any chosen word plays no part: its score is zero.
    sentences = np.array([sum("vile" in part for part in t.decode().split(". ")) for t in texts])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    with_word = sentences > 0
    assert list(names) == [place[0, 0]]

    def loss(z):
        miss = np.exp(-sentences * np.logaddexp(0, z))[with_word]
        return (weight[with_word] * np.where(y[with_word] > 0, -np.log(1 - miss), -np.log(miss))).mean()
    assert loss(weights[names[0]] + bias) <= min(loss(z) for z in np.arange(-3, 9, 0.01)) + 1e-3


def test_language_model_against_dense_ridge(spark, monkeypatch):
    """Every text a landmark: the Nystroem solution is dense kernel ridge regression."""
    rnd = random.Random(6)
    words = {"aa": ["abra", "kada", "bra"], "bb": ["xylo", "phon", "zyx"], "cc": ["mimi", "lolo", "nunu"]}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(6)), lang) for i, lang in enumerate(rnd.choice(list(words)) for _ in range(60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, weights = langid.train(docs, landmarks=1000)
    used = [(t, lang) for i, t, lang in rows if crc(i) % 4 != 2]
    grams = Presence(langid.ORDERS, langid.BITS)
    unit = lambda texts: (lambda x: x / langid.length(x))(langid.presence([t.encode() for t in texts], grams)).astype(float)
    x, y = unit([t for t, _ in used]), np.array([[lang == n for n in names] for _, lang in used], float)
    marks = unit(sorted({t for t, _ in used}))
    k, kmm = x @ marks.T, marks @ marks.T
    values, vectors = np.linalg.eigh(kmm)
    phi = k @ (vectors / np.sqrt(np.maximum(values, langid.FLOOR))) @ vectors.T
    ridge = langid.RIDGE * np.trace(phi.T @ phi) / len(marks)
    dense = phi @ np.linalg.solve(phi.T @ phi + ridge * np.eye(len(marks)), phi.T @ y)
    assert abs(x @ weights - dense).max() < 1e-2, abs(x @ weights - dense).max()
    kernel = x @ x.T     # and, in the span of all texts, ridge regression on the full kernel
    full = kernel @ np.linalg.solve(kernel + ridge * np.eye(len(x)), y)
    assert abs(x @ weights - full).max() < 5e-2, abs(x @ weights - full).max()
