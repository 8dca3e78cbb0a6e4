"""Merkle manifest of a corpus, by bitmap-rank indexing.

Each row is a leaf, each source a tree over its leaves in the order of their
ids, and the sources' roots are the leaves of one more tree. A manifest shows
with one digest that nothing has changed, and with a short list of siblings
that a row belongs to the corpus.

*Ranks without sorting.* The ids of a source are merged into a bitmap of
64-bit words, of which only those with a bit are kept (``bit_or``, combined in
the map tasks). A popcount directory over the words gives how many rows come
before each word, level by level: ``DIGITS`` cuts a word's number into parts, so
that one running sum covers at most 2^16 neighbours, whatever the number of
rows. A row's coordinate is a rank query: rows before its word, plus the set
bits below its own. Words whose rows outnumber their bits hold repeated ids; they
are counted id by id (64 at most), and rows of one id are ranked anew by the
digest of the row, then, if that is the same too, by row number (they are
alike, and any order gives the same result).

Names of sources are ranked by the same index, ``CHUNK`` bytes at a time, with
a further turn only for names that agree so far.

*Levels.* Nodes go into arrays of ``ARITY ** HEIGHT`` slots, keyed by the
coordinate, so one shuffle reduces ``HEIGHT`` levels. A source with a third of
all rows is simply more arrays. On the way back each array gets the siblings
above it, and the siblings inside it are added in the task.

Defined results: a null in any column is ``-``; a null id comes first (as the
least bigint) and counts as the empty text in a CRC; a null source is a
source of its own; rows of one id stand in the order of their digests; repeated
rows are leaves of their own; an empty table has no leaves and no root; a long
text is one input of a digest. Columns that are not named are not read, and
clashing names do no harm.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, table, written
from .crc_sql import CRC_TABLE, crc32_sql

ARITY, HEIGHT = 3, 6
SLOTS = ARITY ** HEIGHT
DIGITS = (10, 26, 42)        # bits of a word's number below each level of the directory
CHUNK = 6                    # bytes of a name that are ranked at once
LEAST = -(1 << 63)
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(col: Column) -> Column:
    """``-`` for a null, else the length in bytes, a colon and the value."""
    data = col.cast("string").cast("binary")
    return F.coalesce(F.concat(F.octet_length(data).cast("string").cast("binary"), F.lit(b":"), data), F.lit(b"-"))


def digest(parts: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, parts)), 256)


# Ranks.

def before(words: DataFrame) -> DataFrame:
    """``words`` (g, w, held ...) with ``before``, the rows of g in smaller words,
    and ``of``, all rows of g."""
    levels, at = [], words.select("g", F.col("w").alias("k0"), "held")
    for i, shift in enumerate(DIGITS):
        step = shift - (DIGITS[i - 1] if i else 0)
        at = at.withColumn(f"k{i + 1}", F.shiftright(f"k{i}", step))
        levels.append(at)
        at = at.groupBy("g", f"k{i + 1}").agg(F.sum("held").alias("held"))
    top = len(DIGITS)
    order = Window.partitionBy("g").orderBy(f"k{top}")
    sums = at.select("g", f"k{top}", (F.sum("held").over(order) - F.col("held")).alias("before"),
                     F.sum("held").over(Window.partitionBy("g")).alias("of"))
    for i in reversed(range(top)):
        order = Window.partitionBy("g", f"k{i + 1}").orderBy(f"k{i}")
        inside = levels[i].select("g", f"k{i}", f"k{i + 1}", (F.sum("held").over(order) - F.col("held")).alias("inside"))
        sums = inside.join(sums, ["g", f"k{i + 1}"]).select("g", f"k{i}", (F.col("before") + F.col("inside")).alias("before"), "of")
    return words.join(sums.withColumnRenamed("k0", "w"), ["g", "w"])


def rank_by(rows: DataFrame, key: Column, again) -> DataFrame:
    """``rows`` (g, ...) with ``rank``: how many rows of g have a smaller key,
    a bigint, and ``of``: how many rows g has. Rows that share their key are ranked further by ``again``, a
    function of those rows with a new group (g, key) in place of g."""
    rows = rows.withColumn("key", key).withColumn("w", F.shiftright("key", 6))
    bit, lower = F.expr("shiftleft(1L, cast(key & 63 AS int))"), F.expr("~shiftleft(-1L, cast(key & 63 AS int))")
    words = written(before(rows.groupBy("g", "w").agg(F.bit_or(bit).alias("bits"), F.count("*").alias("held"))), "bitmap")
    below = F.bit_count(F.col("bits").bitwiseAND(lower)).cast("bigint")
    found = rows.join(words, ["g", "w"])
    plain = F.bit_count("bits") == F.col("held")
    crowded = words.filter(~plain)
    if crowded.isEmpty():
        return found.select("*", (F.col("before") + below).alias("rank")).drop("key", "w", "bits", "held", "before")
    ids = rows.join(crowded.select("g", "w", F.col("before").alias("start")), ["g", "w"]).groupBy("g", "w", "start", "key").agg(
        F.count("*").alias("same"))
    own = Window.partitionBy("g", "w").orderBy("key")
    ids = written(ids.select("g", "w", "key", "same", (F.col("start") + F.sum("same").over(own) - F.col("same")).alias("rank")), "repeated")
    found = found.select("*", F.when(plain, F.col("before") + below).alias("single")).drop("bits", "held", "before")
    found = found.join(ids, ["g", "w", "key"], "left")
    placed = written(found.select("*", F.coalesce("single", "rank").alias("at")).drop("single", "w", "rank"), "placed")
    outer, start, size = (f"{c}{len(rows.columns)}" for c in ("outer", "start", "size"))   # turns are nested
    tied = placed.filter("same > 1").withColumn(outer, F.col("g")).withColumn("g", F.struct("g", "key"))
    further = again(tied.withColumnsRenamed({"at": start, "of": size}).drop("key", "same"))
    further = further.withColumns({"g": F.col(outer), "rank": F.col("rank") + F.col(start), "of": F.col(size)}).drop(outer, start, size)
    return placed.filter("same IS NULL OR same = 1").drop("key", "same").withColumnRenamed("at", "rank").unionByName(further)


def ranked(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """``rows`` (g, ...) with ``rank`` by the keys, the first one first."""
    if not keys:
        raise ValueError("rows that share all keys")
    return rank_by(rows, keys[0], lambda tied: ranked(tied, keys[1:]))


def chunk(name: Column, i: int) -> Column:
    """Bytes i * CHUNK to (i + 1) * CHUNK of a name, and how many there are, as
    one number in the names' order (a null name: before all)."""
    part = F.substring(name.cast("binary"), i * CHUNK + 1, CHUNK)
    number = F.conv(F.rpad(F.hex(part), 2 * CHUNK, "0"), 16, 10).cast("bigint")
    return F.coalesce(number * (CHUNK + 1) + F.octet_length(part), F.lit(-1).cast("bigint"))


def ranked_names(names: DataFrame, name: Column, i: int = 0) -> DataFrame:
    """``names`` (g, ...), distinct, with ``rank`` by their bytes."""
    return rank_by(names, chunk(name, i), lambda tied: ranked_names(tied, name, i + 1))


# Levels.

def joined(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def levels_of(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """The nodes and the levels above them in one array: ``HEIGHT`` levels, or,
    if the array is its whole tree, as many as lead to one node."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= HEIGHT:
        last = out[-1]
        out.append([joined(last[i:i + ARITY]) for i in range(0, len(last), ARITY)])
    return out


def siblings(levels: list[list[bytes]], place: int) -> list[tuple[bytes, bytes]]:
    """Per level, what stands to the left and to the right of a node's run."""
    path = []
    for level in levels[:-1]:
        run = place - place % ARITY
        path.append((b"".join(level[run:place]), b"".join(level[place + 1:run + ARITY])))
        place //= ARITY
    return path


def slots(array: pa.Array) -> Iterator[list[dict]]:
    """Each array of slots as a list in the order of its keys."""
    for value in array:
        rows = value.as_py()
        placed = [None] * len(rows)
        for row in rows:
            placed[row["place"]] = row
        yield placed


def flat(path: list[tuple[bytes, bytes]]) -> str:
    return ",".join(f"{a.decode()}.{b.decode()}" for a, b in path)


def opened(path: str) -> list[tuple[bytes, bytes]]:
    return [tuple(x.encode() for x in level.split(".")) for level in path.split(",")] if path else []


def arrays(nodes: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Nodes (g, n, slot, node, extra ...) as slot arrays (g, n, block, slots)."""
    member = F.struct((F.col("slot") % SLOTS).cast("int").alias("place"), "node", *extra)
    return nodes.groupBy("g", "n", F.floor(F.col("slot") / SLOTS).alias("block")).agg(F.collect_list(member).alias("slots"))


def tops(blocks: DataFrame) -> DataFrame:
    """(g, n, slot, node, done) of the arrays' top nodes, as nodes of the next band."""
    @F.arrow_udf("string")
    def top(members: pa.Array, n: pa.Array) -> pa.Array:
        return pa.array([levels_of([r["node"].encode() for r in placed], size.as_py() <= SLOTS)[-1][0].decode()
                         for placed, size in zip(slots(members), n)], pa.string())
    nodes = F.transform("slots", lambda s: F.struct(s["place"].alias("place"), s["node"].alias("node")))
    return blocks.select("g", F.col("n").alias("of"), F.col("block").alias("slot"), top(nodes, F.col("n")).alias("node")).select(
        "g", F.ceil(F.col("of") / SLOTS).alias("n"), "slot", "node", (F.col("of") <= SLOTS).alias("done"))


def forest(nodes: DataFrame, extra: list[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Bands of slot arrays from the leaves up, and (g, node) of the roots."""
    bands, roots = [], None
    while True:
        bands.append(written(arrays(nodes, extra), "slots"))
        extra = []
        up = written(tops(bands[-1]), "nodes")
        done = up.filter("done").select("g", "node")
        roots = done if roots is None else roots.unionByName(done)
        nodes = up.filter("NOT done").drop("done")
        if nodes.isEmpty():
            return bands, roots


def paths(band: DataFrame, above: DataFrame) -> DataFrame:
    """(g, block, path, subroot) of the band below: each node of ``band`` with the
    siblings on its way up. ``above``: the same of the arrays."""
    @F.arrow_udf("array<struct<place:int,path:string>>")
    def down(members: pa.Array, n: pa.Array, upper: pa.Array) -> pa.Array:
        out = []
        for placed, size, rest in zip(slots(members), n, upper):
            levels = levels_of([r["node"].encode() for r in placed], size.as_py() <= SLOTS)
            tail = opened(rest.as_py())
            out.append([{"place": i, "path": flat(siblings(levels, i) + tail)} for i in range(len(placed))])
        return pa.array(out, pa.list_(pa.struct([("place", pa.int32()), ("path", pa.string())])))
    nodes = F.transform("slots", lambda s: F.struct(s["place"].alias("place"), s["node"].alias("node")))
    found = band.join(above, ["g", "block"]).select("g", "block", "subroot", F.explode(down(nodes, "n", "path")).alias("s"))
    return found.select("g", (F.col("block") * SLOTS + F.col("s.place")).alias("block"), F.col("s.path").alias("path"), "subroot")


PROOF = ("id bigint, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string, "
         "verified boolean")


def prove(blocks: DataFrame, root: str, texts: bool) -> DataFrame:
    """One row per leaf of arrays (slots with id, node, other; n, path, subroot):
    its siblings up to the root, their digest, and the root that ``other`` (a
    changed leaf, if any) leads to."""
    small_batches(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, kinds = hashlib.sha256, pa.schema([
            ("id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof", "proof_sha256", "folded_root")),
            ("verified", pa.bool_())])
        for batch in batches:
            rest = [batch.column(c).to_pylist() for c in ("n", "path", "subroot")]
            for placed, n, path, subroot in zip(slots(batch.column("slots")), *rest):
                levels = levels_of([r["node"].encode() for r in placed], n <= SLOTS)
                tail, rows = opened(path), []
                upper = b"".join(a + b for a, b in tail)
                for i, row in enumerate(placed):
                    inside = siblings(levels, i)
                    proof = b"".join([a + b for a, b in inside]) + upper
                    node = (row["other"] or row["node"]).encode()
                    for a, b in inside + tail:
                        node = sha(a + node + b).hexdigest().encode()
                    folded = node.decode()
                    rows.append((row["id"], row["node"], subroot, root, proof.decode() if texts else None,
                                 sha(proof).hexdigest(), folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
    return blocks.select("n", "path", "subroot", "slots").mapInArrow(run, PROOF)


class Manifest:
    """A manifest of ``docs``: ``sources`` (source, n, subroot, slot), ``root``
    (a digest; None of an empty table) and ``proofs``."""

    def __init__(self, docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source: str = "source",
                 tampered: tuple[str, Column, Column] | None = None):
        """``columns``: what a leaf covers, in this order. ``tampered``: a column,
        its changed value, and which rows are checked with it."""
        named = {c: F.col(f"`{c}`") for c in columns}
        changed = F.lit(None).cast("string")
        if tampered:
            column, value, where = tampered
            changed = F.when(where & value.isNotNull() & (value != named[column]), digest([value if c == column else named[c] for c in columns]))
        name = F.col(f"`{source}`").cast("string")
        leaves = docs.select(F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("g"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                             digest(list(named.values())).alias("node"), changed.alias("other"), F.monotonically_increasing_id().alias("row"))
        leaves = written(leaves, "leaves")
        spread = F.conv(F.substring("node", 1, 15), 16, 10).cast("bigint")
        placed = ranked(leaves, [F.coalesce("id", F.lit(LEAST)), spread, F.col("row")]).withColumnsRenamed({"rank": "slot", "of": "n"})
        self.bands, subroots = forest(placed, ["id", "other"])
        names = subroots.select(F.lit("").alias("g"), F.col("g").alias("tree"), "node")
        plain = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
        self.trees = written(ranked_names(names, plain), "sources")
        counts = leaves.groupBy(F.col("g").alias("tree")).agg(F.count("*").alias("n"))
        self.sources = self.trees.join(counts, "tree").select(plain.alias("source"), "n", F.col("node").alias("subroot"), F.col("rank").alias("slot"))
        self.top, roots = forest(self.trees.select("g", F.col("of").alias("n"), F.col("rank").alias("slot"), "node"))
        found = roots.first()           # one row, or none
        self.root = found.node if found else None

    def proofs(self, texts: bool = True) -> DataFrame:
        """(id, leaf, subroot, root, proof, proof_sha256, folded_root, verified)
        for every row; ``proof`` (all siblings in a row) only on request."""
        spark = self.trees.sparkSession
        way = spark.createDataFrame([("", 0, "", None)], "g string, block bigint, path string, subroot string")
        for band in reversed(self.top):
            way = paths(band, way)
        way = way.drop("g").join(self.trees, F.col("block") == F.col("rank"))
        start = way.select(F.col("tree").alias("g"), F.lit(0).cast("bigint").alias("block"), "path", F.col("node").alias("subroot"))
        here = None
        for height in reversed(range(len(self.bands))):
            # Trees whose only array lies in this band begin here.
            single = start.join(self.bands[height].filter(F.col("n") <= SLOTS).select("g").distinct(), "g", "left_semi")
            here = single if here is None else here.unionByName(single)
            if height:
                here = paths(self.bands[height], here)
        return prove(self.bands[0].join(here, ["g", "block"]), self.root, texts)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    made = Manifest(docs, tampered=("text", F.translate("text", "\n", ""), even))
    return made.proofs(texts=False).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def encoded_sql(col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def leaf_sql(columns) -> str:
    return f"sha256({' || '.join(map(encoded_sql, columns))})"


# Levels by recursion; each row's path is a list of 'left,right', folded by a
# list function. Rows alike in all columns are told apart by ``rid``.
OP12_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, {leaf_sql(COLUMNS)} AS leaf,
         CASE WHEN {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 2 = 0
              THEN {leaf_sql([c if c != 'text' else "replace(text, chr(10), '')" for c in COLUMNS])} ELSE {leaf_sql(COLUMNS)} END AS other
  FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS slot FROM d),
lower AS (
  SELECT g, 0 AS level, slot, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM p
  UNION ALL
  SELECT g, level + 1, slot // {ARITY}, sha256(string_agg(h, '' ORDER BY slot)), (n + {ARITY - 1}) // {ARITY}
  FROM lower WHERE n > 1 GROUP BY g, level, slot // {ARITY}, n),
subs AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place FROM lower WHERE n = 1),
upper AS (
  SELECT 0 AS level, place AS slot, subroot AS h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT level + 1, slot // {ARITY}, sha256(string_agg(h, '' ORDER BY slot)), (n + {ARITY - 1}) // {ARITY}
  FROM upper WHERE n > 1 GROUP BY level, slot // {ARITY}, n),
own AS (
  SELECT x.g, x.level, x.slot, coalesce(string_agg(y.h, '' ORDER BY y.slot) FILTER (y.slot < x.slot), '') AS l,
         coalesce(string_agg(y.h, '' ORDER BY y.slot) FILTER (y.slot > x.slot), '') AS r
  FROM lower x JOIN lower y ON y.g = x.g AND y.level = x.level AND y.slot // {ARITY} = x.slot // {ARITY} WHERE x.n > 1 GROUP BY ALL),
topmost AS (
  SELECT x.level, x.slot, coalesce(string_agg(y.h, '' ORDER BY y.slot) FILTER (y.slot < x.slot), '') AS l,
         coalesce(string_agg(y.h, '' ORDER BY y.slot) FILTER (y.slot > x.slot), '') AS r
  FROM upper x JOIN upper y ON y.level = x.level AND y.slot // {ARITY} = x.slot // {ARITY} WHERE x.n > 1 GROUP BY ALL),
ways AS (
  SELECT rid, 0 AS tree, level, l, r FROM p JOIN own ON own.g = p.g AND own.slot = p.slot // CAST(power({ARITY}, own.level) AS BIGINT)
  UNION ALL
  SELECT rid, 1, level, l, r FROM p JOIN subs ON subs.g = p.g JOIN topmost ON topmost.slot = place // CAST(power({ARITY}, topmost.level) AS BIGINT)),
proof AS (
  SELECT rid, string_agg(l || r, '' ORDER BY tree, level) AS proof, list(l || ',' || r ORDER BY tree, level) AS steps FROM ways GROUP BY rid)
SELECT doc_id, leaf, subroot, h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       list_reduce(list_concat([other], coalesce(steps, [])), lambda a, s: sha256(split_part(s, ',', 1) || a || split_part(s, ',', 2))) AS folded_root,
       folded_root = root AS verified
FROM p JOIN subs ON subs.g = p.g JOIN (SELECT h FROM upper WHERE n = 1) ON true LEFT JOIN proof ON proof.rid = p.rid
"""
