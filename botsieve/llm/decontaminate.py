"""Benchmark decontamination by a generalised suffix automaton of the items.

The normalised words of the benchmark items are numbered and put into one
generalised suffix automaton. A document's words are streamed through it: each
word takes a transition or falls back along suffix links, so after every word
the automaton's state and length say how long the longest item passage ending
there is. A passage of ``window`` words (or a whole shorter item) marks its
words as hit. Spans of hit words are reported, and cut out or the document
dropped once they exceed the limits.

The automaton is built per block of items. A block holds at most
``BLOCK_BYTES`` of item text (or one longer item), so what is collected and
broadcast at once is bounded however large the benchmark is. Texts are matched
against one block after the other and never written for it; what they hit is
merged.

Words: A-Z in lower case, then runs of digits, letters a-z and non-ASCII
characters. Defined results: null and empty texts have no words and are never
contaminated; null and empty items have no windows; an item without an id
marks words but is not listed; repeated items and ids count once; empty tables
give empty results or clean documents; long texts and repetitive items take
time in proportion to their words; other columns of the documents are kept.
"""

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch_udf, struct_array, table, unused, utf8, written

WINDOW = 13
MAX_SHARE = 20             # contaminated: n_hit * MAX_SHARE >= n_words
MAX_SPAN = WINDOW          # the pipeline cuts hit spans of so many words out of what stays
BLOCK_BYTES = 4 << 20      # item text per automaton
SMALL = 100_000            # rows of hits (spans and items of one text) that may be broadcast

# Bytes of words stay (A-Z in lower case), all others become spaces.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
             for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


class Automaton:
    """Generalised suffix automaton over the words of some items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, data in items:
            if words := words_of(data):
                coded.append((name, [self.ids.setdefault(w, len(self.ids)) for w in words]))
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self.extend(last, c)
        # Per state, where its path of suffixes first is no longer than a window
        # would be: one pass in the order of lengths, so that no match climbs.
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.anchor = [0] * len(self.link)
        for state in order:
            up = self.link[state]
            self.anchor[state] = state if self.length[up] < window else self.anchor[up]
        # Items by the state of their window (or of a whole short item).
        self.full: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        self.least = window
        for name, codes in coded:
            state, size = 0, 0
            if len(codes) < window:
                self.least = min(self.least, len(codes))
                for c in codes:
                    state = self.next[state][c]
                self.short.setdefault(state, {}).setdefault(len(codes), set()).add(name)
                continue
            for c in codes:
                state, size = self.next[state][c], size + 1
                if size >= window:
                    self.full.setdefault(self.anchor[state], set()).add(name)
        # The nearest state, from each on its path of suffixes, where a short
        # item ends (0: none).
        self.ends = [0] * len(self.link)
        for state in order:
            self.ends[state] = state if state in self.short else self.ends[self.link[state]]

    def add(self, length: int, state: int | None = None) -> int:
        """A new state, as a copy of ``state`` if given."""
        self.next.append({} if state is None else dict(self.next[state]))
        self.link.append(-1 if state is None else self.link[state])
        self.length.append(length)
        return len(self.link) - 1

    def split(self, state: int, c: int) -> int:
        """The state of exactly the words of ``state`` and ``c``: the target of
        the transition, or a copy of it cut down to that length."""
        target = self.next[state][c]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self.add(self.length[state] + 1, target)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(c) == target:
            self.next[state][c] = copy
            state = self.link[state]
        return copy

    def extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self.split(last, c)
        new = self.add(self.length[last] + 1)
        state = last
        while state >= 0 and c not in self.next[state]:
            self.next[state][c] = new
            state = self.link[state]
        self.link[new] = 0 if state < 0 else self.split(state, c)
        return new

    def stream(self, codes: list[int], offset: int, spans: list, found: set) -> int:
        """Streams word numbers; adds hit spans [start, end) and items. The
        longest match is returned."""
        nexts, link, length, ends, window = self.next, self.link, self.length, self.ends, self.window
        full, anchor, short = self.full, self.anchor, self.short
        state = size = longest = 0
        for at, c in enumerate(codes, offset + 1):
            target = nexts[state].get(c)
            while target is None and state:
                state = link[state]
                size = length[state]
                target = nexts[state].get(c)
            if target is None:
                continue
            state = target
            size += 1
            if size > longest:
                longest = size
            if size >= window:
                found |= full[anchor[state]]
                if spans and spans[-1][1] >= at - window and spans[-1][0] <= at - window:
                    spans[-1][1] = at
                else:
                    spans.append([at - window, at])
            path = ends[state]
            while path:          # at most one state for each length below a window
                for k, names in short[path].items():
                    if k <= size:
                        found |= names
                        spans.append([at - k, at])
                path = ends[link[path]]
        return longest

    def match(self, data: bytes, longest_too: bool = False) -> tuple[int, list, list, int | None]:
        """(words, merged hit spans, items, longest match if asked for) of one document."""
        words = words_of(data)
        if not self.ids or not words:
            return len(words), [], [], 0 if longest_too else None
        codes = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        # Runs of words that items have; only those at least as long as the
        # shortest window can hold one. For the longest match a shorter run is
        # streamed too, if it can hold a longer one than those before it.
        known = np.concatenate(([False], codes >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        spans, found, longest = [], set(), 0
        for i in np.flatnonzero(sizes >= self.least):
            a, b = int(starts[i]), int(starts[i] + sizes[i])
            longest = max(longest, self.stream(codes[a:b].tolist(), a, spans, found))
        short = np.flatnonzero((sizes < self.least) & (sizes > longest)) if longest_too else ()
        for i in sorted(short, key=lambda i: -sizes[i]):
            if sizes[i] <= longest:
                break
            a, b = int(starts[i]), int(starts[i] + sizes[i])
            longest = max(longest, self.stream(codes[a:b].tolist(), a, spans, found))
        return len(words), merged(spans), sorted(n for n in found if n is not None), longest if longest_too else None


def merged(spans: list) -> list[tuple[int, int]]:
    out = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def blocks(bench: DataFrame, id_col: str, text_col: str):
    """The benchmark's distinct rows in blocks of at most ``BLOCK_BYTES`` of
    text (or one longer item), one at a time. Items are put in an order and cut
    into parts by running totals: an item above a sixteenth of a block is a part
    of its own, and the others make parts of less than an eighth. Only the
    parts' sizes come to the driver, which joins neighbours to blocks."""
    items = written(bench.select(F.col(id_col).cast("string").alias("id"), utf8(text_col).alias("text"))
                    .filter(F.length("text") > 0).distinct(), "bench-items")
    items = items.withColumn("size", F.length("text").cast("bigint"))
    total, most = items.agg(F.sum("size")).first()[0] or 0, max(1, BLOCK_BYTES // 16)
    hashed = F.xxhash64("id", "text")
    items = items.withColumn("hash", hashed).withColumn("lane", F.pmod("hash", F.lit(total // (16 * BLOCK_BYTES) + 1)))
    order = Window.partitionBy("lane").orderBy("hash", "id", "text").rowsBetween(Window.unboundedPreceding, 0)
    small = F.col("size") <= most
    before = F.sum(F.when(small, F.col("size")).otherwise(0)).over(order) - F.col("size")
    part = F.when(small, F.floor(before / most)).otherwise(-F.count_if(~small).over(order))
    items = written(items.select("id", "text", "size", "lane", part.cast("bigint").alias("part")), "bench-parts")
    bounds, size = [], 0
    for r in items.groupBy("lane", "part").agg(F.sum("size").alias("size")).orderBy("lane", "part").toLocalIterator():
        if not bounds or size + r["size"] > BLOCK_BYTES:
            bounds.append([(r["lane"], r["part"])] * 2)
            size = 0
        bounds[-1][1] = (r["lane"], r["part"])
        size += r["size"]
    if not bounds:
        yield []
    for first, last in bounds:
        low, high = (F.struct(F.lit(x).cast("bigint"), F.lit(y).cast("bigint")) for x, y in (first, last))
        inside = F.struct("lane", "part").between(low, high)
        yield [(r["id"], bytes(r["text"])) for r in items.filter(inside).select("id", "text").collect()]


HITS = "n_words bigint, spans array<struct<a:bigint,b:bigint>>, items array<string>, longest bigint"


def hit_column(spark: SparkSession, items: list, text: str | Column, window: int, longest: bool = False) -> Column:
    """struct(n_words, spans, items, longest) of a text against one block."""
    block = spark.sparkContext.broadcast(items)
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    kinds = [("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string())), ("longest", pa.int64())]

    def make():
        automaton = Automaton(block.value, window)

        def run(texts):
            rows = [automaton.match(t.as_py() or b"", longest) for t in texts]
            return struct_array(kinds, [[r[0] for r in rows],
                                        [[{"a": a, "b": b} for a, b in r[1]] for r in rows],
                                        [r[2] for r in rows], [r[3] for r in rows]])
        return run
    return batch_udf(make, HITS)(utf8(text))


def further_hits(docs: DataFrame, items: list, text: str, window: int, longest: bool) -> DataFrame:
    """(key, spans, items, longest) of the distinct texts that one more block
    hits, by the texts' digest: a written table without texts."""
    found = docs.select(digest_of(text).alias("key"), hit_column(docs.sparkSession, items, text, window, longest).alias("h"))
    found = found.filter((F.size("h.spans") > 0) | (F.col("h.longest") > 0)).select("key", "h.spans", "h.items", "h.longest")
    return written(found.dropDuplicates(["key"]), "hits")


def digest_of(text: str) -> Column:
    return F.unhex(F.md5(utf8(text)))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", out: str = "hits", longest: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` (in place of one so named): n_words, n_hit, spans (of word
    places), items (ids), the contaminated flag and, if asked for, the longest match.

    The first block is matched in place. Each further one reads the texts again
    and writes what it hits, which is joined back by the texts' digest: by
    broadcast if it is small, otherwise by a shuffle."""
    spark = docs.sparkSession
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
    listed = blocks(bench, item_id, item_text)
    first, others = next(listed), None
    for items in listed:
        found = further_hits(docs, items, text, window, longest)
        others = found if others is None else others.unionByName(found)
    own, key, more = unused(docs.columns, "hits_own", "hits_key", "hits_more")
    docs = docs.withColumn(own, hit_column(spark, first, text, window, longest))
    spans, names, far = F.col(f"{own}.spans"), F.col(f"{own}.items"), F.col(f"{own}.longest")
    if others is not None:
        others = others.groupBy(F.col("key").alias(key)).agg(F.struct(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
            F.max("longest").alias("longest")).alias(more))       # at most one row for each block
        others = written(others, "hits")
        docs = docs.withColumn(key, digest_of(text)).join(F.broadcast(others) if others.count() <= SMALL else others, key, "left")
        nothing = F.expr("cast(array() AS array<struct<a:bigint,b:bigint>>)"), F.expr("cast(array() AS array<string>)")
        spans = F.concat(spans, F.coalesce(F.col(f"{more}.spans"), nothing[0]))
        names = F.concat(names, F.coalesce(F.col(f"{more}.items"), nothing[1]))
        far = F.greatest(far, F.col(f"{more}.longest"))
    reach = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    n_hit = F.aggregate(F.sort_array(spans), reach, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"),
        F.greatest(s["end"], x["b"]).alias("end")), lambda s: s["n"])
    docs = docs.select(*kept, F.struct(
        F.col(f"{own}.n_words").alias("n_words"), n_hit.alias("n_hit"), F.sort_array(spans).alias("spans"),
        F.array_sort(F.array_distinct(names)).alias("items"), far.alias("longest")).alias(out))
    share = F.col(f"{out}.n_hit") * MAX_SHARE >= F.col(f"{out}.n_words")
    return docs.withColumn(out, F.col(out).withField("contaminated", (F.col(f"{out}.n_hit") > 0) & share))


def cut_spans(text: str | Column, spans: Column, least: Column) -> Column:
    """``text`` without the words of ``spans`` and what lies between them, once
    overlapping and touching spans are one; only spans of at least ``least``
    words count (null: none do). Null if nothing is cut."""
    def make():
        def run(texts, lists, leasts):
            out = []
            for t, s, n in zip(texts, lists, leasts):
                places = [(p["a"], p["b"]) for p in s.as_py() or []] if n.is_valid else []
                places = [(a, b) for a, b in merged(places) if b - a >= n.as_py()]
                if not places:
                    out.append(None)
                    continue
                data = t.as_py() or b""
                folded = data.translate(FOLD)
                bounds, at = [], 0
                for w in folded.split():
                    at = folded.index(w, at)
                    bounds.append((at, at + len(w)))
                    at += len(w)
                kept, at = [], 0
                for a, b in places:
                    kept.append(data[at:bounds[a][0]])
                    at = bounds[b - 1][1]
                out.append(b"".join([*kept, data[at:]]))
            return pa.array(out, pa.binary())
        return run
    some = F.when(F.size(spans) > 0, F.col(text) if isinstance(text, str) else text)   # other texts need not go to Python
    return batch_udf(make, "binary", 3)(utf8(some), spans, least.cast("bigint")).cast("string")


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text: str = "text",
                  on_coverage: str = "drop", max_span: int | None = None, chars: str | None = None, **columns) -> DataFrame:
    """Documents under the limits. A document whose hit words reach the
    coverage limit is dropped (``on_coverage="drop"``) or loses its spans
    (``"cut"``). With ``max_span``, spans of at least that many words are cut
    out of the other documents as well; what a cut brings together is looked at
    again, until no such span is left. ``chars`` names a column of the text's
    length, which follows a cut. All else stays as it is."""
    if on_coverage not in ("drop", "cut"):
        raise ValueError(f"on_coverage must be drop or cut, not {on_coverage!r}")
    hits, after, gone = unused(docs.columns, "hits", "after", "gone")
    columns_kept = [F.col(f"`{c}`") for c in docs.columns]
    kind = dict(docs.dtypes).get(chars)
    done = None
    while True:
        found = contamination(docs, bench, window, text, out=hits, **columns)
        over, least = F.col(f"{hits}.contaminated"), F.lit(max_span).cast("bigint")
        if on_coverage == "drop" and max_span is None:
            return found.filter(~over).select(*columns_kept)
        if done is not None:
            over = F.lit(False)   # the coverage limit is for the text as it came
        elif on_coverage == "drop":
            least = F.when(~over, least)
        else:
            over, least = F.lit(False), F.when(over, 1).otherwise(least)
        # Dropped after the write: a filter here would match every text twice.
        cut = found.withColumn(gone, over).withColumn(after, cut_spans(text, F.col(f"{hits}.spans"), least))
        if kind:
            cut = cut.withColumn(chars, F.when(F.col(after).isNotNull(), F.length(after).cast(kind)).otherwise(F.col(f"`{chars}`")))
        cut = cut.withColumn(text, F.coalesce(after, F.col(f"`{text}`"))).withColumn(after, F.col(after).isNotNull())
        if max_span is None:
            return cut.select(*columns_kept)
        cut = written(cut.select(*columns_kept, after, gone), "decontaminated")
        rest = cut.filter(~F.col(after) & ~F.col(gone)).select(*columns_kept)
        done = rest if done is None else done.unionAll(rest)
        docs = cut.filter(after).select(*columns_kept)
        if docs.isEmpty():
            return done


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "hits.n_words", "hits.n_hit",
                        F.size("hits.items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hits.items").cast("binary"), 256).alias("items_sha256"),
                        "hits.contaminated")


WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')")

OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS k, 13 AS size
  FROM (SELECT item, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)
  UNION
  SELECT item, array_to_string(w, ' '), len(w) FROM b WHERE len(w) BETWEEN 1 AND 12),
sizes AS (SELECT DISTINCT size FROM win),
places AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS k
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes)),
found AS (SELECT rid, item, i, places.size AS size FROM places JOIN win USING (k)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT rid, i, size FROM found)) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.rid = d.rid LEFT JOIN named ON named.rid = d.rid
"""
