import random
import re
from collections import Counter

import pytest
from conftest import SF0001
from llm_cases import edge_docs, edge_rows, no_docs, save

from botsieve.llm import quality_rules as q

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_metrics_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = q.op5(spark, SF0001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in METRICS) == slow(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("long", [q.LONG, 0, 10])
def test_metrics_of_random_texts(spark, monkeypatch, long):
    """Also where all texts, or some, are sorted by whole hashes."""
    monkeypatch.setattr(q, "LONG", long)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["a", "b", "c ", " ", "\n", "\t", "|", "é", "$ ", "\x0b", " ", "aa ", "b a "])
                     for _ in range(rnd.randrange(120))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in q.text_metrics(docs).collect():
        want = slow(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[:5], texts[r.doc_id]


def test_edge_cases(spark, tmp_path):
    rows = q.op5(spark, save(tmp_path, documents=edge_docs(spark))).collect()
    want = sorted((str(r[0]), *slow(r[1])) for r in edge_rows())
    assert sorted((str(r.doc_id), *(r[c] for c in METRICS)) for r in rows) == want
    assert q.op5(spark, save(tmp_path / "none", documents=no_docs(spark))).count() == 0


def test_thresholds_follow_the_group(spark, monkeypatch):
    """A share of symbols that is usual in one source is an outlier in another;
    small groups take their language's thresholds, with broadcast or not."""
    rnd = random.Random(9)

    def text(signs):
        words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(100)]
        return " ".join(w + ("$" if i < signs else "") for i, w in enumerate(words))
    rows = [(i, text(0), "en", "plain") for i in range(100)] + [(1000 + i, text(40), "en", "shell") for i in range(100)]
    rows += [(2000, text(40), "en", "plain"), (2001, text(0), "en", "plain"), (2002, text(40), "en", "shell"),
             (2003, text(100), "en", "new"), (2004, text(0), None, None), (2005, text(10), "xx", "yy")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    for most in (q.SMALL, 0):
        monkeypatch.setattr(q, "SMALL", most)
        kept = {r.doc_id: r.kept for r in q.judge(docs).collect()}
        assert not kept[2000] and kept[2001] and kept[2002] and kept[2004]
        assert all(kept[i] for i in [*range(100), *range(1000, 1100)])


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    plan = q.text_metrics(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
