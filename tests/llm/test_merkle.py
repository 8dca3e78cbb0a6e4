import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import edge_docs, edge_rows, no_docs, save
from pyspark.sql import functions as F

from botsieve.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, place):
    out = []
    for level in levels[:-1]:
        run = place // 3 * 3
        out.append(("".join(level[run:place]), "".join(level[place + 1:run + 3])))
        place //= 3
    return out


def by_hand(rows):
    """Rows of op12 for (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        changed = text.replace("\n", "") if text is not None and zlib.crc32(str("" if i is None else i).encode()) % 2 == 0 else text
        groups[source].append((i is not None, i or 0, leaf((i, source, lang, n, text)), leaf((i, source, lang, n, changed))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(groups[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for slot, (known, i, own, other) in enumerate(sorted(groups[s])):
            steps = way(trees[s], slot) + way(top, place)
            folded = other
            for a, b in steps:
                folded = h(a, folded, b)
            out.append((i if known else None, own, trees[s][-1][0], top[-1][0], h(*(a + b for a, b in steps)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("height", [6, 1])
def test_edge_cases_against_brute_force(spark, tmp_path, monkeypatch, height):
    """Nulls, repeated ids and rows, a long text; with one-level arrays too."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "SLOTS", 3 ** height)
    rows = [r[:5] for r in edge_rows()] + [(i, f"line\n{i}", "en", "a" * 7 + "b" * (i % 3), i) for i in range(20, 50)]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(rows[len(edge_rows()):], "doc_id bigint, text string, lang string, source string, n_chars bigint"),
                                        allowMissingColumns=True)
    got = result(merkle.op12(spark, save(tmp_path, documents=docs)))
    assert got == by_hand(rows)


def test_empty_table(spark, tmp_path):
    assert merkle.op12(spark, save(tmp_path, documents=no_docs(spark))).count() == 0


def test_ranks_without_sorting(spark):
    """Sparse, negative and extreme keys, and a key that a third of the rows share."""
    keys = [-(1 << 63), (1 << 63) - 1, -1, 0, 63, 64, 65, 1 << 40, -(1 << 40), *range(-300, 300, 7), *[64 * i * i * 977 for i in range(200)]]
    rows = [(g, k, i) for i, k in enumerate(keys) for g in ("a", "b")] + [("a", 5, 1000 + i) for i in range(150)]
    df = spark.createDataFrame(rows, "g string, k bigint, i bigint").repartition(5)
    got = merkle.ranked(df, [F.col("k"), F.col("i")]).collect()
    for g in ("a", "b"):
        want = sorted((k, i) for x, k, i in rows if x == g)
        assert sorted(((r.k, r.i) for r in got if r.g == g)) == want
        assert sorted((r["rank"], r.k, r.i) for r in got if r.g == g) == [(n, *key) for n, key in enumerate(want)]


def test_names_are_ranked_by_bytes(spark):
    names = ["", "a", "a\x00", "ab", "src1", "src10", "src2", "prefix-that-is-long-1", "prefix-that-is-long-10", "prefix-that-is-long-2", "é", "日本", None]
    df = spark.createDataFrame([("", n) for n in names], "g string, name string")
    got = sorted((r["rank"], r.name) for r in merkle.ranked_names(df, F.col("name")).collect())
    want = sorted(names, key=lambda n: (n is not None, (n or "").encode()))
    assert [n for _, n in got] == want and [k for k, _ in got] == list(range(len(names)))


def test_manifest_outputs_and_tampering(spark):
    """Sources with roots in their order; each proof's siblings lead to the root,
    and a row changed in any column no longer does."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
                                    F.lit(9).alias("n_chars"))
    made = merkle.Manifest(docs, tampered=("lang", F.lit("de"), F.col("doc_id") % 10 == 0))
    sources = made.sources.orderBy("slot").collect()
    assert [r.source for r in sources] == ["hot", "s0", "s1", "s2", "s3", "s4"] and sum(r.n for r in sources) == 2000
    rows = made.proofs().collect()
    assert Counter(r.verified for r in rows) == {True: 1800, False: 200}
    assert all(r.verified == (r.id % 10 > 0) and hashlib.sha256(r.proof.encode()).hexdigest() == r.proof_sha256 for r in rows)
    assert {r.root for r in rows} == {made.root} and len({r.leaf for r in rows}) == 2000
    again = merkle.Manifest(docs.repartition(7))
    assert again.root == made.root
    assert merkle.Manifest(docs.filter("doc_id != 77")).root != made.root
