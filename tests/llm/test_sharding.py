import zlib
from collections import Counter

import pytest
from conftest import SF0001
from llm_cases import edge_docs, edge_rows, no_docs, save
from pyspark.sql import functions as F

from botsieve.llm import sharding


def check_law(rows, total):
    counts = Counter(r.shard for r in rows)
    assert sum(counts.values()) == total and max(counts) < sharding.SHARDS
    sizes = [counts[k] for k in range(sharding.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    for k in counts:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))


@pytest.mark.parametrize("rows_of_bucket, run", [(1000, 1000), (3, 2)])
def test_law_mixture_and_stability(spark, monkeypatch, rows_of_bucket, run):
    monkeypatch.setattr(sharding, "ROWS", rows_of_bucket)
    monkeypatch.setattr(sharding, "RUN", run)
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = sharding.interleave(docs).collect()
    check_law(rows, docs.count())
    n, share = Counter(r.source for r in rows), Counter((r.source, r.shard) for r in rows)
    for source, total in n.items():
        for k in range(sharding.SHARDS):
            assert abs(share[source, k] - total / sharding.SHARDS) <= 2
    other = sharding.interleave(docs.repartition(7, "text")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, other))


def test_buckets_do_not_change_the_order(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    one = sorted(map(tuple, sharding.interleave(docs).collect()))
    monkeypatch.setattr(sharding, "ROWS", 5)
    monkeypatch.setattr(sharding, "RUN", 3)
    assert sorted(map(tuple, sharding.interleave(docs).collect())) == one


def test_edge_cases(spark, tmp_path):
    rows = sharding.op3(spark, save(tmp_path, documents=edge_docs(spark))).collect()
    check_law(rows, len(edge_rows()))
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in edge_rows())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert sharding.op3(spark, save(tmp_path / "none", documents=no_docs(spark))).count() == 0


def test_hot_source_is_spread(spark):
    """No bucket of a source with half of all rows is much above ``ROWS``."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                      F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("source"))
    bits = (40_000 // sharding.ROWS).bit_length()
    bucket = F.shiftright(sharding.shuffle_hash("doc_id", "text", sharding.SEED), sharding.HASH_BITS - bits)
    most = docs.groupBy("source", bucket.alias("b")).count().agg(F.max("count")).first()[0]
    assert most < 2 * sharding.ROWS
    rows = sharding.interleave(docs).groupBy("shard").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "hot").alias("h"))
    assert {(r.n, abs(r.h - 2500) <= 2) for r in rows.collect()} == {(5000, True)}


def test_sources_of_one_row_are_spread(spark):
    """A source per row, as of hosts: no bucket of the second ranking is much above ``ROWS``."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("host"), "id").alias("source"))
    bits = (40_000 // sharding.ROWS).bit_length()
    place = F.floor((F.lit(1.0) - sharding.offset("s")) * (1 << bits))
    most = docs.select(F.concat(F.lit("="), "source").alias("s")).groupBy(place.alias("b")).count().agg(F.max("count")).first()[0]
    assert most < 2 * sharding.ROWS
    rows = sharding.interleave(docs).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"))
    assert {(r.n, r["last"]) for r in rows.collect()} == {(5000, 4999)}
