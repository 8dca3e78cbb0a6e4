import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from llm_cases import edge_docs, edge_rows, no_docs, save

from botsieve.llm import spelling


def count_by_hand(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(counts):
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if abs(len(w) - len(word)) < 2 and is_near(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= 10 * n else None
        out[word] = [n, len(near), form, counts[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def result(df):
    rows = df.collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(got) == len(rows)
    return got


def mutated(rng, word):
    at, c = rng.randrange(len(word)), rng.choice("abcdeé÷")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + c + word[at:], word[:at] + c + word[at + 1:]])


def variant_texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 10))) for _ in range(30)]
    words += [mutated(rng, w) for w in words for _ in range(6)] + [mutated(rng, mutated(rng, w)) for w in words for _ in range(3)]
    return [(i, " ".join(rng.choices(words, [1 + 300 * (k < 8) + 20 * (k % 17 == 0) for k in range(len(words))], k=rng.randrange(0, 60))) + ".X" * (i % 3)) for i in range(200)]


@pytest.mark.parametrize("bucket", [1000, 2, 0])
def test_against_brute_force(spark, tmp_path, monkeypatch, bucket):
    """All signatures joined; some crowded; all crowded."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (bucket,))
    monkeypatch.setattr(spelling.variants, "__defaults__", (10, bucket))
    rows = variant_texts(bucket) + [(300, "chainword " * 500 + "chainwords " * 40 + "chainwordsy chainwordsy ")]
    docs = spark.createDataFrame([(i, t.upper() if i % 5 == 0 else t) for i, t in rows], "doc_id bigint, text string").repartition(4)
    want = by_hand(count_by_hand([(r.doc_id, r.text) for r in docs.collect()]))
    assert result(spelling.op11(spark, save(tmp_path, documents=docs))) == want
    assert any(r[2] for r in want.values()) and any(r[4] != r[2] for r in want.values() if r[2])


def test_signatures_miss_no_edit():
    rng = random.Random(5)
    for _ in range(20_000):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(7, 13)))
        b = mutated(rng, a)
        if a == b or len(b) < 7:
            continue
        x, y = {s for s in spelling.signatures(a)}, {s for s in spelling.signatures(b)}
        if len(a) == len(b):
            assert any(role == 0 for _, role in x & y)
        else:
            short, long = (x, y) if len(a) < len(b) else (y, x)
            assert {k for k, role in short if role == 1} & {k for k, role in long if role == 2}


def test_edge_cases(spark, tmp_path):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = result(spelling.op11(spark, save(tmp_path, documents=edge_docs(spark))))
    assert got == by_hand(count_by_hand(rows)) and "morning" in got
    assert spelling.op11(spark, save(tmp_path / "none", documents=no_docs(spark))).count() == 0


def test_long_texts_and_words(spark, tmp_path, monkeypatch):
    """Texts are read in pieces that cut no word; a word may be very long; counts are handed out as they fill up."""
    monkeypatch.setattr(spelling, "PIECE", 50)
    monkeypatch.setattr(spelling, "COUNTED", 3)
    rows = [(1, "y" * 20_000 + " " + "abcdefgh " * 500), (2, "y" * 20_000 + "z abcdefgi abcdefgi" + " abcdefgh" * 40), (3, "y" * 20_000), (4, ("y" * 20_000 + "z. ") * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(spelling.op11(spark, save(tmp_path, documents=docs))) == by_hand(count_by_hand(rows))


def test_no_pair_is_lost_in_a_crowd(spark):
    """Anagrams of one another share every signature; both ways give the same pairs."""
    words = sorted({"".join(p) for p in (random.Random(i).sample("aabbccddee", 8) for i in range(400))})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {(a, b) for a, b in combinations(words, 2) if is_near(a, b)}
    for bucket in (1000, 3):
        assert {tuple(r) for r in spelling.near_words(df, bucket).collect()} == want
