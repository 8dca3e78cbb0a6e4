import random
import re

import xxhash
from conftest import SF0001
from llm_cases import edge_docs, edge_rows, no_docs, save

from botsieve.llm import simhash
from botsieve.llm.common import written
from botsieve.llm.components import components


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def slow_classes(prints, limit=2):
    """Smallest place of each one's component, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= limit:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_query_against_brute_force(spark):
    rows = sorted(simhash.op1(spark, SF0001).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    prints = [slow_print(texts[r.doc_id]) for r in rows]
    assert [int(r.fingerprint, 16) for r in rows] == prints
    assert [r.component_id for r in rows] == [rows[c].doc_id for c in slow_classes(prints)]


def test_edge_cases(spark, tmp_path):
    rows = simhash.op1(spark, save(tmp_path, documents=edge_docs(spark))).collect()
    assert len(rows) == len(edge_rows())
    by_id = {r.doc_id: r for r in rows}
    zero = "0" * 16
    assert sorted(str(r.doc_id) for r in rows if r.fingerprint == zero) == ["3", "4", "5", "None"]
    assert {r.component_id for r in rows if r.fingerprint == zero} == {3}
    assert by_id[5].component_id == by_id[4].component_id == 3
    assert by_id[1].component_id == by_id[0].component_id == 0
    assert by_id[9].fingerprint == f"{xxhash.xxh64_intdigest(b'one', 42):016x}"
    assert by_id[10].fingerprint == f"{xxhash.xxh64_intdigest(b'two words', 42):016x}"
    assert simhash.op1(spark, save(tmp_path / "none", documents=no_docs(spark))).count() == 0


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choice("abcdefg") * 3 for _ in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole


def test_large_buckets_lose_no_link(spark):
    """Groups of near fingerprints, far larger than a bucket, chained over
    several steps; classes are those of all pairs."""
    rnd, prints = random.Random(3), []
    for size in (1, 2, 40, 150, 300):
        x = rnd.getrandbits(64)
        for _ in range(size):
            prints.append(x)
            y = x
            for _ in range(rnd.randrange(4)):
                y ^= 1 << rnd.randrange(64)
            prints.append(y)
            if rnd.random() < 0.3:
                x ^= 1 << rnd.randrange(64)
    rows = [(i, simhash.signed(p)) for i, p in enumerate(prints)]
    table = written(spark.createDataFrame(rows, "doc_id bigint, fp bigint"), "prints")
    found = {r.fp: r.component_id for r in simhash.classes(table).collect()}
    assert [found[fp] for _, fp in rows] == slow_classes(prints)


def test_other_parts_and_distances(spark):
    rnd, prints = random.Random(4), []
    for _ in range(60):
        x = rnd.getrandbits(64)
        for bits in range(6):
            y = x
            for b in rnd.sample(range(64), bits):
                y ^= 1 << b
            prints.append(y)
    rows = [(i, simhash.signed(p)) for i, p in enumerate(prints)]
    table = written(spark.createDataFrame(rows, "doc_id bigint, fp bigint"), "prints")
    for limit, parts in ((4, 3), (2, 3)):
        found = {r.fp: r.component_id for r in simhash.classes(table, max_bits=limit, segments=parts).collect()}
        assert [found[fp] for _, fp in rows] == slow_classes(prints, limit)


def test_deduplicate(spark):
    docs = edge_docs(spark)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [0, 2, 3, 6, 7, 8, 9, 10, 11, None]))  # the id-less English text is alone
    assert simhash.deduplicate(no_docs(spark)).count() == 0


def test_components_of_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501), (500, 501)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
