"""Spelling variants by PartEnum signatures.

Two words are near if one code point is inserted, deleted or replaced between
them. Their multisets of letters, as binary vectors (one place for each letter
and each time it occurs), then have a Hamming distance of at most two, and of
one if the lengths differ.

*Signatures.* The letters are dealt into parts. Of ``parts`` parts a pair at
distance d differs in at most d, so it agrees in all of some ``parts - d`` of
them: every choice of that many parts is enumerated, and what a vector has in
the chosen parts is a signature (four parts, two chosen, for words of one
length; two parts, one chosen, for lengths one apart). A single edit also
leaves the first or the second half of the shorter length untouched, so each
signature is taken over one half of the word and keyed by the other half, once
for either side. All words near each other share a signature; words are joined
by equal signatures and verified by their edit distance.

*Crowded signatures.* A signature of more than ``BUCKET`` words is not joined.
Its words list what is left of them after each deletion of one code point
(and themselves, without a place): words are near exactly if a deletion of one
is the other, or both agree after a deletion at one place. That is one row per
code point, however many words share the signature.

*Counts.* Runs are counted in the tasks and summed by word. What is carried per
word is the word, so texts are read once and never shuffled.

Defined results: null and empty texts have no words; a null id counts as the
empty text in the CRC; repeated rows count again; ties among the commonest near
words go to the smallest in code-point order; an empty table has no words; a
long text is read in pieces that end outside a word, and a word may be of any
length; other columns are not read.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, written
from .crc_sql import CRC_TABLE, crc32_sql

LETTERS = r"a-zÀ-ÿ"    # of a run, once A-Z are lower-case
LEAST_LENGTH, LEAST_COUNT, FACTOR, DAMAGE = 7, 2, 10, 31
PIECE = 1 << 18                  # characters of a text that are split into runs at once
COUNTED = 100_000                # words that a task holds before it hands out their counts
BUCKET = 1000                    # words of a signature that are joined with each other
DEALT = 20_000                   # words of a task that makes signatures
SMALL = 200_000                  # crowded signatures (8 bytes each) that may be broadcast


def pieces(text: str, outside: re.Pattern) -> Iterator[str]:
    at = 0
    while at < len(text):
        gap = outside.search(text, at + PIECE) if at + PIECE < len(text) else None
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = max(stop, at + 1)


def damaged(word: str, seed: int, modulus: int) -> str:
    """The word, or in one of ``modulus`` cases the word without one letter."""
    h = zlib.crc32(word.encode(), seed)
    return word[:h % len(word)] + word[h % len(word) + 1:] if h % modulus == 0 else word


def words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
          least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of the runs of letters of all texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = re.compile(f"[{LETTERS}]{{{least_length},}}"), re.compile(f"[^{LETTERS}]")
        total = Counter()

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out
        for batch in batches:
            for i, data in zip(batch.column("id").to_pylist(), batch.column("data")):
                data = data.as_py()
                if not data:
                    continue
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for part in pieces(data.lower().decode("utf-8", "replace"), outside):   # bytes: A-Z only
                    for word, n in Counter(inside.findall(part)).items():
                        word = damaged(word, seed, damage)
                        if len(word) >= least_length:
                            total[word] += n
                    if len(total) > COUNTED:
                        yield counts()
        if total:
            yield counts()
    found = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").cast("binary").alias("data"))
    found = found.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= least_count)


def signatures(word: str) -> list[tuple[int, int]]:
    """(signature, role) of a word: role 0 among words of its length, 1 as the
    shorter and 2 as the longer of lengths one apart."""
    out, n = [], len(word)
    for role, short, parts, distance in ((0, n, 4, 2), (1, n, 2, 1), (2, n - 1, 2, 1)):
        half = short // 2
        for side, same, rest in (("<", word[:half], word[half:]), (">", word[n - half:], word[:n - half])):
            dealt = [""] * parts
            for letter in sorted(rest):
                dealt[ord(letter) % parts] += letter
            for chosen in combinations(range(parts), parts - distance):
                key = f"{bool(role)}{short}{side}{same}{chosen}" + "|".join(dealt[c] for c in chosen)
                out.append((xxhash.xxh64_intdigest(key) - (1 << 63), role))
    return out


def signature_rows(found: DataFrame) -> DataFrame:
    """(signature, role, word) of every word of a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, roles, names, size = [], [], [], 0
            for word in batch.column("word").to_pylist():
                for key, role in signatures(word):
                    keys.append(key)
                    roles.append(role)
                    names.append(word)
                size += 20 * len(word)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roles, pa.int8()), pa.array(names)], names=["signature", "role", "word"])
                    keys, roles, names, size = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roles, pa.int8()), pa.array(names, pa.string())], names=["signature", "role", "word"])
    # A table of words is short on disk, but a word has many signatures.
    dealt = found.select("word").repartition(found.count() // DEALT + 1, "word")
    return dealt.mapInArrow(run, "signature bigint, role tinyint, word string")


def without_one(crowd: DataFrame) -> DataFrame:
    """Pairs (a, b) of near words among ``crowd`` (word), by what is left after
    a deletion: ``place`` 0 is the whole word."""
    left = F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda i: F.struct(i.alias("place"), F.concat(
        F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.char_length("word"))).alias("rest")))
    rows = crowd.select("word", F.inline(left))
    whole = crowd.select(F.col("word").alias("rest"), F.col("word").alias("b"))
    other = rows.select("place", "rest", F.col("word").alias("b"))
    replaced = rows.withColumnRenamed("word", "a").join(other, ["place", "rest"]).filter("a < b").select("a", "b")
    deleted = rows.withColumnRenamed("word", "a").join(whole, "rest").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return replaced.unionByName(deleted)


def near_words(found: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct pairs (a, b), a < b, of near words of a written table (word)."""
    rows = written(signature_rows(found), "signatures")
    large = written(rows.groupBy("signature").count().filter(F.col("count") > bucket).select("signature"), "crowded")
    many = large.count()
    pairs = None
    if many:
        large = F.broadcast(large) if many <= SMALL else large
        pairs = without_one(written(rows.join(large, "signature", "left_semi").select("word").distinct(), "crowd"))
        rows = rows.join(large, "signature", "left_anti")
    a = rows.filter("role < 2").select("signature", F.col("word").alias("a"), F.col("role").alias("a_role"))
    b = rows.filter("role != 1").select("signature", F.col("word").alias("b"), F.col("role").alias("b_role"))
    fits = ((F.col("a_role") == 0) & (F.col("b_role") == 0) & (F.col("a") < F.col("b"))) | ((F.col("a_role") == 1) & (F.col("b_role") == 2))
    met = a.join(b, "signature").filter(fits).filter(F.levenshtein("a", "b", 1) == 1)
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return (met if pairs is None else met.unionByName(pairs)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): the end of its chain of forms. A form
    occurs far more often than its word, so chains are short and have an end;
    each round halves what is left of them."""
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        state = written(state, "roots")
        next_ = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if state.join(next_, "root", "left_semi").isEmpty():
            return state
        state = state.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"))


def variants(found: DataFrame, factor: int = FACTOR, bucket: int = BUCKET) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for words (word, n): ``form`` is the
    commonest near word if it occurs at least ``factor`` times as often."""
    found = written(found.select("word", "n"), "words")
    pairs = written(near_words(found, bucket), "near")
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = found.select(F.col("word").alias("b"), F.col("n").alias("other_n"))
    best = sides.join(other, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "b")).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"))
    near = written(found.join(best, "word"), "best")
    is_form = F.col("form_n") >= F.lit(factor) * F.col("n")
    near = near.select("word", "n", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    ends = roots(near.filter("form IS NOT NULL"))
    near = near.select("word", "n_near", "form", "form_n").join(ends, "word", "left")
    return found.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form", "form_n",
                                                   F.coalesce("root", "word").alias("root"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(words(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")


OP11_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql("id || ':' || run")} AS h FROM runs, crc),
changed AS (
  SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
rests AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word AS a, y.word AS b FROM rests x JOIN rests y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT word, rest FROM rests WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM rests WHERE rest IN (SELECT word FROM words)),
best AS (
  SELECT a, count(*) AS n_near, arg_min(b, struct_pack(k := -n, w := encode(b))) AS form, max(n) AS form_n FROM near JOIN words ON b = word GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {FACTOR} * n THEN form END AS form, CASE WHEN form_n >= {FACTOR} * n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON a = word),
chain AS (
  SELECT word, word AS at, form FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT forms.word, forms.form, chain.at AS root, n, n_near, form_n FROM forms JOIN chain ON chain.word = forms.word AND chain.form IS NULL
"""
