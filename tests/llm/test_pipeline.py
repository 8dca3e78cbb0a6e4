import duckdb
import numpy as np
import pytest
from conftest import SF001
from llm_cases import edge_docs, no_docs
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from botsieve.llm import bpe, catalog, decontaminate, pii, simhash, toxicity
from botsieve.llm.common import table

NAMES = [name for name in catalog.queries()]


def test_one_query_per_operator():
    assert len({int(n[2:].split("_")[0]) for n in NAMES}) == len(NAMES)
    assert set(catalog.oracle_sql()) <= set(NAMES)
    assert set(NAMES) | {"pipeline"} <= set(entry_module.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe_encoding"]


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = catalog.queries()[name](spark, SF001)
    key = lambda row: tuple((v is None, v) for v in row)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=lambda r: [(x is None, str(x)) for x in r])
    res = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in res.fetchall()), key=lambda r: [(x is None, str(x)) for x in r])
    assert list(map(key, got)) == list(map(key, want))


def test_pipeline_stage_by_stage(spark):
    """Each stage's result is what its operator's query says of its input."""
    docs = table(spark, SF001, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF001).cache()
    scores = {r.doc_id: r.predicted for r in toxicity.op8(spark, SF001).collect()}
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p}
    single = stages["near_duplicates"](spark, clean, SF001).cache()
    groups = simhash.near_duplicates(clean).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    plain = stages["decontamination"](spark, single, SF001).cache()
    hits = decontaminate.contamination(single, table(spark, SF001, "benchmark")).collect()
    assert {r.doc_id for r in plain.collect()} == {r.doc_id for r in hits if not r.hits.contaminated}
    masked = stages["personal_data"](spark, plain, SF001).cache()
    assert masked.columns == docs.columns and masked.count() == plain.count()
    assert masked.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert masked.select(pii.span_column("text").alias("s")).filter(F.size("s") > 0).count() == 0
    coded = stages["bpe_encoding"](spark, masked, SF001)
    texts = {r.doc_id: r.text for r in masked.collect()}
    encoder = bpe.Encoder(bpe.vocabulary(spark).value)
    rows = coded.collect()
    assert len(rows) == len(texts)
    for r in rows[:200]:
        ids = encoder.encode(texts[r.doc_id])
        assert np.frombuffer(ids, "<i4").tolist() == r["ids"] and encoder.decode(r["ids"]) == r.decoded and r.n_tokens == len(r["ids"])
    whole = corpus_pipeline.run(spark, SF001)
    assert whole.columns == coded.columns
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((r.doc_id, r.n_tokens) for r in rows)


def test_stages_bear_edge_cases(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, no_docs(spark)):
            out = stage(spark, some, SF001)
            assert out.count() <= some.count()
            if name != "bpe_encoding":
                assert out.columns == some.columns


def test_no_benchmark_window_passes_the_pipeline_stage(spark):
    """Documents that stay lose their passages of a window and more, and only those."""
    docs = table(spark, SF001, "documents")
    hits = {r.doc_id: r for r in decontaminate.contamination(docs, table(spark, SF001, "benchmark")).collect()}
    plain = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF001)
    assert plain.columns == docs.columns and plain.filter(F.length("text") != F.col("n_chars")).count() == 0
    kept = {r.doc_id: r.text for r in plain.collect()}
    long = {i for i, r in hits.items() if any(b - a >= decontaminate.WINDOW for a, b in r.hits.spans)}
    assert set(kept) == {i for i, r in hits.items() if not r.hits.contaminated} and long & set(kept)
    assert all(kept[i] == r.text for i, r in hits.items() if i in kept and i not in long)
    left = decontaminate.contamination(plain, table(spark, SF001, "benchmark")).collect()
    assert not any(b - a >= decontaminate.WINDOW for r in left for a, b in r.hits.spans)


def test_a_stage_leaves_only_its_result(spark):
    """The run's folder holds the stages' tables; cut points inside a stage are gone."""
    from botsieve.session import shared_root
    from botsieve.sources.shared_files import SharedFiles
    files, root = SharedFiles(spark), shared_root(spark)
    before = set(files.names(root))
    out = corpus_pipeline.run(spark, SF001)
    made = sorted(n.rsplit("-", 1)[0] for n in set(files.names(root)) - before)
    assert made == sorted(f"stage-{n}" for n, _ in corpus_pipeline.STAGES[:-1])
    assert out.count() > 0
