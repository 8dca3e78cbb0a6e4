import hashlib
import random
import re
import time

from llm_cases import edge_docs, edge_rows, no_docs, save

from botsieve.llm import decontaminate as d

BENCH = "item_id bigint, text string"
ITEM = " ".join(f"w{i}" for i in range(20))


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def slow(text, items, size=13):
    """(words, hit places, ids) by comparing every window at every place."""
    doc, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for win in ([w[i:i + size] for i in range(len(w) - size + 1)] if len(w) >= size else [w] if w else []):
            for i in range(len(doc) - len(win) + 1):
                if doc[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(name)
    return doc, hit, found


def longest_by_hand(doc, items):
    return max((n for _, item in items for w in [words(item)] for i in range(len(doc)) for n in range(1, len(doc) - i + 1)
                if any(w[k:k + n] == doc[i:i + n] for k in range(len(w) - n + 1))), default=0)


def test_automaton_against_brute_force():
    rnd = random.Random(3)
    for _ in range(1500):
        size, letters = rnd.choice([2, 3, 4, 13]), rnd.choice([2, 3, 6])
        make = lambda n: " ".join(f"w{rnd.randrange(letters)}" for _ in range(n))
        items = [(str(i), make(rnd.randrange(30 if size == 13 else 12))) for i in range(rnd.randrange(6))]
        text = make(rnd.randrange(60))
        doc, hit, found = slow(text, items, size)
        n, spans, names, longest = d.Automaton([(i, t.encode()) for i, t in items], size).match(text.encode(), True)
        assert n == len(doc) and names == sorted(found)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert all(a < b for a, b in spans)
        if len(doc) < 25:
            assert longest == longest_by_hand(doc, items)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_query_and_edge_cases(spark, tmp_path):
    docs = spark.createDataFrame([(100, "Start " + ITEM.upper() + ", end.", "en", "a", None, *["x"] * 8),
                                  (101, ITEM + " filler" * 600, "en", "a", None, *["x"] * 8),
                                  (102, " ".join(ITEM.split()[:12]), "en", "a", None, *["x"] * 8),
                                  (103, "a short item here", "en", "a", None, *["x"] * 8)], edge_docs(spark).schema)
    items = [(1, ITEM), (1, ITEM), (2, "Short item!"), (3, None), (4, ""), (None, "near the river"), (10, "one"), (9, "one")]
    folder = save(tmp_path, documents=edge_docs(spark).unionByName(docs), benchmark=spark.createDataFrame(items, BENCH))
    out = d.op7(spark, folder)
    assert out.count() == len(edge_rows()) + 4
    got = rows_of(out)
    for i, text in [*((r[0], r[1]) for r in edge_rows() if r[0] is not None), *((r.doc_id, r.text) for r in docs.collect())]:
        doc, hit, found = slow(text, items)
        names = sorted(str(n) for n in found if n is not None)
        want = (len(doc), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                bool(hit) and 20 * len(hit) >= len(doc))
        assert tuple(got[i])[1:] == want
    assert got[9].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    none = save(tmp_path / "none", documents=no_docs(spark), benchmark=spark.createDataFrame([], BENCH))
    assert d.op7(spark, none).count() == 0
    empty = save(tmp_path / "nobench", documents=edge_docs(spark), benchmark=spark.createDataFrame([], BENCH))
    assert not any(r.contaminated or r.n_hit for r in d.op7(spark, empty).collect())


def test_many_blocks_give_the_same(spark, monkeypatch):
    rnd = random.Random(5)
    items = [(i, " ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(3, 20)))) for i in range(30)]
    docs = [(i, " ".join(rnd.choice("abcdefg") for _ in range(80))) for i in range(30)] + [(99, None)]
    docs, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, BENCH)
    pick = lambda: sorted((r.doc_id, r.hits.n_words, r.hits.n_hit, r.hits["items"], r.hits.contaminated)
                          for r in d.contamination(docs, bench, 4).collect())
    one = pick()
    monkeypatch.setattr(d, "BLOCK_BYTES", 200)
    assert pick() == one


def test_limits(spark):
    bench = spark.createDataFrame([(1, ITEM)], BENCH)
    docs = spark.createDataFrame([(1, "Keep this. " + ITEM + " And that."), (2, ITEM + " x" * 2000 + "."), (3, None), (4, "clean")],
                                 "doc_id bigint, text string")
    drop = rows_of(d.decontaminate(docs, bench))
    assert set(drop) == {2, 3, 4} and drop[2].text.startswith("w0 ") and drop[3].text is None
    cut = rows_of(d.decontaminate(docs, bench, on_coverage="cut", max_span=15))
    assert cut[1].text == "Keep this.  And that." and cut[2].text == " x" * 2000 + "." and cut[4].text == "clean"
    assert cut[3].text is None
    long = rows_of(d.decontaminate(docs, bench, max_span=50))
    assert long[2].text.startswith("w0 ")


def test_clashing_column_is_replaced(spark):
    docs = edge_docs(spark)
    found = d.contamination(docs, spark.createDataFrame([(1, ITEM)], BENCH))
    assert sorted(found.columns) == sorted(docs.columns) and found.schema["hits"].dataType.typeName() == "struct"
    kept = d.decontaminate(docs, spark.createDataFrame([(1, ITEM)], BENCH))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_long_spans_leave_documents_that_stay(spark):
    """Everything but the spans stays as it is; a text that a cut brings
    together is looked at again; a span made by two blocks is one span."""
    nested = " ".join(ITEM.split()[:8]) + " " + " ".join(f"v{i}" for i in range(15)) + " " + " ".join(ITEM.split()[8:])
    items = [(1, ITEM), (2, " ".join(f"v{i}" for i in range(15))), (3, "p q r s t u v"), (4, "u v w x y z a b")]
    rest = " x" * 2000
    docs = [(1, "Keep: " + ITEM.upper() + rest + "\n", 5), (2, nested + rest, 5), (3, " ".join(ITEM.split()[:12]) + rest, 5),
            (4, "so p q r s t u v w x y z a b" + rest, 5), (5, "so p q r s t u v" + rest, 5), (6, None, None), (7, ITEM, 5)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars int")
    bench = spark.createDataFrame(items, BENCH)
    got = rows_of(d.decontaminate(docs, bench, max_span=13, chars="n_chars"))
    same = {r.doc_id: r for r in docs.collect() if r.doc_id in (3, 5, 6)}
    assert {i: got[i] for i in same} == same
    want = {1: "Keep: " + rest + "\n", 2: rest, 4: "so " + rest}
    assert {i: (got[i].text, got[i].n_chars) for i in want} == {i: (t, len(t)) for i, t in want.items()}
    assert set(got) == {*same, *want}


def test_long_spans_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", 60)
    test_long_spans_leave_documents_that_stay(spark)


def test_longest_match_against_brute_force():
    """The longest run of words that a text shares with one item, also below a window."""
    rnd = random.Random(8)
    for _ in range(500):
        make = lambda n: [f"w{rnd.randrange(8)}" for _ in range(n)]
        items, text = [make(rnd.randrange(30)) for _ in range(rnd.randrange(5))], make(rnd.randrange(60))
        parts = {tuple(w[i:j]) for w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        want = max((j - i for i in range(len(text)) for j in range(i + 1, len(text) + 1) if tuple(text[i:j]) in parts), default=0)
        automaton = d.Automaton([(str(i), " ".join(w).encode()) for i, w in enumerate(items)])
        assert automaton.match(" ".join(text).encode(), True)[3] == want


def test_blocks_keep_their_bound(spark, monkeypatch):
    """Copies of an item count once, and no block is above the bound."""
    rnd = random.Random(6)
    items = [(i, "x" * rnd.choice([3, 10, 40, 90, 700, 1500])) for i in range(300)] + [(7, "copy " * 40)] * 150 + [(None, "none")] * 2
    bench = spark.createDataFrame([*items, (1, None), (2, "")], BENCH)
    monkeypatch.setattr(d, "BLOCK_BYTES", 1000)
    got = list(d.blocks(bench, "item_id", "text"))
    assert sorted(map(str, (x for b in got for x in b))) == sorted(str((None if i is None else str(i), t.encode())) for i, t in set(items))
    sizes = [sum(len(t) for _, t in b) for b in got]
    assert all(n <= 1000 or len(b) == 1 for n, b in zip(sizes, got))
    assert len(got) < 3 * sum(sizes) / 1000
    assert list(d.blocks(bench.limit(0), "item_id", "text")) == [[]]


def test_repetitive_items_take_linear_time():
    """Items and texts of one word over and over, with a short item inside."""
    start = time.perf_counter()
    items = [("long", b"a " * 4000), ("ab", b"a b " * 3000), ("short", b"a"), ("pair", b"a a b")]
    automaton = d.Automaton(items)
    for text in (b"a " * 200_000, b"a b " * 100_000, (b"a " * 4001 + b"c ") * 50):
        n, spans, names, _ = automaton.match(text)
        assert n == len(text.split()) and "short" in names and (names == ["ab", "short"] if b"b" in text else "long" in names)
    assert time.perf_counter() - start < 20


def test_texts_are_not_written_for_further_blocks(spark, monkeypatch):
    """Twenty blocks: tables of hits by digest, no column of texts, and the same result."""
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(20))) for i in range(20)]
    docs = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(40)) + (" " + items[i][1] if i < 15 else "")) for i in range(25)] * 2
    docs = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id bigint, text string, hits_own string, hits_key string")
    bench = spark.createDataFrame(items, BENCH)
    pick = lambda: sorted((r.doc_id, r.hits.n_words, r.hits.n_hit, r.hits["items"], r.hits.longest, r.hits_own, r.hits_key)
                          for r in d.contamination(docs, bench, 5, longest=True).collect())
    one, tables = pick(), []
    monkeypatch.setattr(d, "BLOCK_BYTES", 50)
    monkeypatch.setattr(d, "written", lambda df, name, f=d.written: tables.append((name, df.columns)) or f(df, name))
    assert pick() == one
    assert sum(name == "hits" for name, _ in tables) == 20      # 19 further blocks, and their sum
    assert all(name.startswith("bench") or not {"text", "doc_id"} & set(columns) for name, columns in tables)
    monkeypatch.setattr(d, "SMALL", 0)
    assert pick() == one
