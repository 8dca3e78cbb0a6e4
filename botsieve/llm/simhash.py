"""SimHash near-duplicates by multi-index hashing.

Each text gets a 64-bit fingerprint: bit i is set if it is set in over half of
the XXH64 hashes of its word shingles. Texts whose fingerprints differ in at
most ``max_bits`` bits are linked, and a document's class is the component of
its links.

*Index.* Only distinct fingerprints are indexed (copies share one). The bits
are cut into ``segments`` parts; by the pigeonhole principle two fingerprints
within the distance agree up to a small radius in at least one part. For two
bits and two parts that is radius 1 in the first or radius 0 in the second.
Every fingerprint enumerates the Hamming ball of that radius in each part,
fetches the table's matches by an equi-join, and complete distances are
verified. A ball's keys above the own value are left out: the other
fingerprint of the pair finds it from its side.

*Large buckets.* Near copies can share a part by the thousand, and fetching all
pairs of a bucket would be quadratic. Beyond ``BUCKET`` entries a bucket is
only marked, and whoever probes it (members included) goes through an exact
second way: it lists the points of its own complete ball of radius 1. Two
fingerprints differ in at most two bits exactly if they share such a point, a
point has at most 65 members, and all of them are linked to the smallest. That
is 65 rows for each fingerprint, whatever the size of the group, and no link
between different components is lost. For other distances than 2 the points
are of radius ``max_bits // 2`` (even distances only).

Defined results: null or empty texts have fingerprint zero and are linked like
any other; fewer words than the shingle length are one shingle; a class is
named by its smallest id (nulls ignored; null if it has no id); repeated rows
stay repeated rows; extra columns are not touched.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_udf, table, unused, utf8, written
from .components import components

SHINGLE, MAX_BITS, SEGMENTS = 3, 2, 2
SEED = 42
BITS = 64
BUCKET = 32               # entries of an index bucket that probes fetch one by one
BLOCK = 1 << 16           # shingles whose bits are counted at once
SMALL = 2_000_000         # rows (8 bytes each) of a list that may be broadcast


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's UTF-8 bytes."""
    words = data.lower().split()   # bytes: A-Z only; \x20 and \x09-\x0D separate
    if not words:
        return 0
    size = min(shingle, len(words))
    total = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, BLOCK):
        stop = min(at + BLOCK, total)
        grams = map(b" ".join, zip(*(words[at + i:stop + i] for i in range(size))))
        hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams, repeat(SEED))), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def fingerprint_column(text: str | Column, shingle: int = SHINGLE) -> Column:
    def make():
        def run(texts):
            return pa.array([fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())
        return run
    return batch_udf(make, "bigint")(utf8(text))


def hexadecimal(col: str) -> Column:
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def radii(max_bits: int, segments: int) -> list[int]:
    """Per part, the radius in which a pair within ``max_bits`` must agree in
    at least one part (-1: the part is not needed)."""
    whole, rest = divmod(max_bits, segments)
    return [whole if i <= rest else whole - 1 for i in range(segments)]


def masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def ball(i: int, part: Column, around: list[int]) -> Column:
    """Keys of a part's Hamming ball up to its own value, as array<struct<part, key>>."""
    keys = F.transform(F.array(*[F.lit(signed(m)) for m in around]), lambda m: part.bitwiseXOR(m))
    keys = F.filter(keys, lambda k: k <= part)
    return F.transform(keys, lambda k: F.struct(F.lit(i).alias("part"), k.alias("key")))


def links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) among distinct fingerprints ``prints.fp`` (a table): every
    pair within the distance is an edge or joined by edges over fingerprints
    that are within the distance of each other."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    index, probes, low = [], [], 0
    for i, radius in enumerate(radii(max_bits, segments)):
        bits = BITS // segments + (i < BITS % segments)
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(signed((1 << bits) - 1)))
        low += bits
        if radius < 0:
            continue
        index.append(F.struct(F.lit(i).alias("part"), part.alias("key")))
        probes.append(ball(i, part, masks(bits, radius)))
    entries = prints.select("fp", F.inline(F.array(*index)))
    probes = prints.select("fp", F.inline(F.concat(*probes)))
    large = written(entries.groupBy("part", "key").count().filter(F.col("count") > bucket).select("part", "key"), "buckets")
    fetched = entries.join(large, ["part", "key"], "left_anti").withColumnRenamed("fp", "other").unionByName(
        large.withColumn("other", F.lit(None).cast("bigint")).withColumn("large", F.lit(True)), allowMissingColumns=True)
    # One join: single entries come back as candidates, marked buckets as marks.
    # Complete distances are verified here, before anything is written.
    near = F.col("large") | (distance("fp", "other") <= max_bits) & (F.col("fp") != F.col("other"))
    found = written(probes.join(fetched, ["part", "key"]).filter(near).select("fp", "other"), "candidates")
    pairs = found.filter("other IS NOT NULL").select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowd = found.filter("other IS NULL").select("fp").distinct()
    points = crowd.select("fp", F.explode(F.transform(
        F.array(*[F.lit(signed(m)) for m in masks(BITS, max_bits // 2)]),
        lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    first = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z").select("point", "a")
    met = points.join(first, "point").select("a", F.col("fp").alias("b")).filter("a != b")
    return pairs.unionByName(met)


def classes(prints: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of a written table
    (id, fp): root names the component, component_id is its smallest id."""
    nodes = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    linked = components(links(nodes.select("fp"), max_bits, segments)).withColumnRenamed("node", "fp")
    linked = written(nodes.join(linked, "fp"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("fp", "root", "component_id")
    alone = nodes.join(linked, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row per document: (id, fp, component_id)."""
    prints = written(docs.select(F.col(id_col), fingerprint_column(text, shingle).alias("fp")), "prints")
    found = classes(prints, id_col, max_bits, segments).select("fp", "component_id")
    return prints.join(found, "fp").select(id_col, "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls
    last; of repeated rows, any one). Rows and texts are not shuffled unless
    the list of rows to drop is too long to be broadcast."""
    row, fp = unused(docs.columns, "row", "fp")
    marked = written(docs.withColumn(row, F.monotonically_increasing_id())
                     .withColumn(fp, fingerprint_column(text, shingle)), "marked")
    slim = marked.select(F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    found = classes(slim, "id", max_bits, segments).select("fp", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    best = slim.groupBy("fp").agg(first.alias("best")).join(found, "fp")
    best = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    # Rows that go are fewer than rows that stay in most corpora.
    gone = written(slim.select("row").join(best, "row", "left_anti").withColumnRenamed("row", row), "gone")
    gone = F.broadcast(gone) if gone.count() <= SMALL else gone
    return marked.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")
