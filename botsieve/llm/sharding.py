"""Shards with the corpus' mixture, by proportional stratified interleaving.

Rows of each source are put in a seeded shuffled order and ranked. The rank as
a fraction of the source's size, ``(r - u) / n`` with an offset u in [0, 1) from
the source's name, spreads every source evenly over (0, 1]; sorting all rows by
that fraction interleaves the sources in proportion, and cutting the order into
equal runs gives shards whose counts differ by at most one and whose share of
each source matches the corpus'. The offset keeps apart what many sources have
in common: of a million sources of one row each, every fraction is another.

*Scale.* Neither rank is taken in one task. Both orders are dealt into buckets
of about ``ROWS`` rows, first by the leading bits of the shuffle hash within a
source, then by the fraction; rows are ranked inside their bucket, and the
buckets' counts, summed up in order, give the rest. Hashes are even, and so are
fractions, be it by the ranks of a source or by the offsets of many, so a source with a third of all rows is spread over as
many buckets as its rows need. Texts are read once, for size and digests, and
are not shuffled.

Law ``rows``. Defined results: a null source is a source of its own; a null
text has size 1 and the CRC of the empty text; a null id is shuffled by its
text; rows alike in id and text are interchangeable; an empty table has no
shards; other columns are not read. The order depends on ids, texts and the
seed alone, not on partitions.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SHARDS, SEED = 8, 17
ROWS, RUN = 1000, 1000   # rows of a bucket, buckets of a run
HASH_BITS = 60     # 15 hexadecimal digits of an MD5


def shuffle_hash(id_col: str, text: str, seed: int) -> Column:
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                      F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def offset(stratum: str) -> Column:
    """In [0, 1), from a source's name: a multiple of 2 to the power -48."""
    return F.conv(F.substring(F.md5(F.col(stratum).cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def bucketed_rank(rows: DataFrame, within: list[str], bucket: str, order: list) -> DataFrame:
    """``rows`` with ``__rank`` from 1 and the size ``__n`` of each ``within``.
    Buckets follow the order; ranks are local to a bucket, and the buckets
    before it are added. Rows are shuffled once, by bucket. The counts (a row
    per bucket) are summed up in order inside runs of ``RUN`` buckets, and the
    runs' totals among each other, so no task sums up more than a row for each
    ``ROWS * RUN`` rows."""
    counts = rows.groupBy(*within, bucket).count().withColumn("__run", F.floor(F.col(bucket) / RUN))
    runs = counts.groupBy(*within, "__run").agg(F.sum("count").alias("c"))
    group = Window.partitionBy(*within)
    runs = runs.select(*within, "__run", F.sum("c").over(group).alias("__n"),
                       (F.sum("c").over(group.orderBy("__run")) - F.col("c")).alias("__runs_before"))
    inside = F.sum("count").over(Window.partitionBy(*within, "__run").orderBy(bucket)) - F.col("count")
    counts = counts.withColumn("__inside", inside).join(runs, [*within, "__run"]).select(
        *within, bucket, "__n", (F.col("__runs_before") + F.col("__inside")).alias("__before"))
    local = F.row_number().over(Window.partitionBy(*within, bucket).orderBy(*order))
    return rows.join(counts, [*within, bucket]).withColumn("__rank", local + F.col("__before")).drop("__before", bucket)


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text: str = "text",
               source: str = "source") -> DataFrame:
    """One row per document: (id, size, text_crc32, source, shard, slot)."""
    data = F.coalesce(F.col("__text"), F.lit("")).cast("binary")
    slim = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text"),
                       F.col(f"`{source}`").alias("__source"))
    slim = written(slim.select("__id", F.coalesce(F.concat(F.lit("="), F.col("__source").cast("string")), F.lit("")).alias("__stratum"),
                               "__source", (F.octet_length(data) + 1).cast("bigint").alias("size"),
                               F.crc32(data).alias("text_crc32"), shuffle_hash("__id", "__text", seed).alias("__hash")), "slim")
    total = slim.count()
    bits = max(0, (max(total, 1) // ROWS).bit_length())
    rows = slim.withColumn("__bucket", F.shiftright("__hash", HASH_BITS - bits))
    ranked = bucketed_rank(rows, ["__stratum"], "__bucket", ["__hash", "__id", "text_crc32", "size"])
    fraction = (F.col("__rank").cast("double") - offset("__stratum")) / F.col("__n").cast("double")
    spread = written(ranked.select("__id", "__source", "__stratum", "size", "text_crc32", F.col("__rank").alias("__own"),
                                   fraction.alias("__fraction"), F.lit(0).alias("__all"),
                                   F.floor(fraction * (1 << bits)).alias("__bucket")), "fractions")
    placed = bucketed_rank(spread, ["__all"], "__bucket", ["__fraction", "__stratum", "__own"])
    total = max(total, 1)
    placed = placed.withColumn("__place", F.col("__rank") - 1)
    placed = placed.withColumn("shard", F.expr(f"int(__place * {shards}L div {total}L)"))
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.select(F.col("__id").alias(id_col), "size", "text_crc32", F.col("__source").alias(source), "shard",
                         (F.col("__place") - first).alias("slot"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return interleave(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))


# CRC-32 in SQL: a table of 256 remainders, then one step per byte.
OP3_SQL = f"""
WITH crc AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], CAST(range(8) AS BIGINT[])),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, encode(coalesce(text, '')) AS data FROM documents),
b AS (
  SELECT doc_id, source, octet_length(data) + 1 AS size,
         xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(data), '..'),
               lambda x: CAST('0x' || x AS BIGINT))),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
         CAST('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(text))), 1, 15)
              AS BIGINT) AS h
  FROM d, crc),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) AS own,
         count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM b),
p AS (
  SELECT *, row_number() OVER (ORDER BY
         (CAST(own AS DOUBLE) - CAST(CAST('0x' || substr(md5(coalesce('=' || source, '')), 1, 12) AS BIGINT) AS DOUBLE) / {float(1 << 48)}) / CAST(n AS DOUBLE),
         coalesce('=' || source, ''), own) - 1 AS place FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(place * {SHARDS} // total AS INTEGER) AS shard,
       CAST(place - ((place * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
