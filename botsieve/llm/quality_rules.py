"""Quality rules with thresholds that adapt to each language and source.

*Metrics.* Per document: words, characters in words, symbols, repeated lines,
words in repeated three-word windows. Every text is read once, in its row; no
text is shuffled. Repeated windows are found by one sort per document: a
window's hash, shifted to make room for the window's place, is sorted as a
plain number, and neighbours with equal hashes are confirmed word by word. That
leaves 51 bits of hash or more; above ``LONG`` words, where windows that only
share those bits might come between, whole hashes are sorted beside the places.

*Thresholds.* Fixed cutoffs are replaced by what is usual in the same language
and source: quartiles of each metric's ratio come from mergeable quantile
(KLL) sketches, and a ratio fails beyond ``FENCE`` quartile distances (at least
``SLACK``) outside the middle half. Rows are read once for all levels: every
task sketches its rows per language and source; those sketches are merged in
``LANES`` lanes per group, the lanes per group, the groups per language, and
the languages for the corpus. A sketch has bounded size (rank error about
``2 / K``; exact up to ``K`` rows), so a group with a third of all rows costs
its task no more than another. A group below ``LEAST`` documents takes its
language's thresholds, a language below that the corpus'.

*Filtering.* Thresholds are joined to the metrics (without texts): by
broadcast while their count is at most ``SMALL``, else by a shuffle whose
skewed partitions Spark splits.

Besides the adaptive thresholds one fixed base rule holds: fewer than
``MIN_WORDS`` words, or more than half of the words in repeated windows.

Defined results: a null or empty text has metrics 0 and fails the base rule; a
null language or source is a group of its own; equal texts of one group get
equal verdicts; repeated rows stay; other columns are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, WORD, table, written

MIN_WORDS, MAX_REPEAT = 50, 50          # words; percent of words in repeated windows
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
LONG = 4096                             # words; longer texts are sorted by whole hashes
# Ratio -> smallest distance from the quartile that can fail.
SLACK = {"symbol_ratio": 0.05, "line_ratio": 0.5, "repeat_ratio": 0.45, "word_length": 3.0}
FENCE, LEAST = 4.0, 50
K, LANES = 2000, 256
SMALL = 100_000                         # threshold rows that may be broadcast


def text_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines (with a
    word), n_dup_lines and n_repeat_words (all bigint)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Each step is its own projection, and uses what the step before made more
    # than once, so nothing is computed twice.
    step = docs.select(*kept, whole.alias("__t"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    step = step.select(*kept, F.regexp_extract_all("__t", F.lit(WORD), F.lit(0)).alias("__w"),
                       F.length(F.regexp_replace("__t", SPACE + "+", "")).cast("bigint").alias("word_chars"),
                       F.regexp_count("__t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"), lines.alias("__l"))
    step = step.select(*kept, "__w", "word_chars", "n_symbols",
                       F.size("__l").cast("bigint").alias("n_lines"),
                       (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
                       F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"), F.size("__w").alias("__n"))
    made = ["word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Bits of the place, windows as numbers: hash above, place below.
    bits = F.ceil(F.log2(F.col("__n") + 1)).cast("int")
    step = step.select(*kept, *made, "__w", "__h", "__n", bits.alias("__b"))
    every = F.sequence(F.lit(0), F.col("__n") - WINDOW)
    none = F.array().cast("array<int>")
    hashed = lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(WINDOW)])
    # Never null, so that the sort is one of plain numbers.
    short = F.transform(F.when((F.col("__n") >= WINDOW) & (F.col("__n") <= LONG), every).otherwise(none), lambda i: F.coalesce(
        F.call_function("shiftleft", hashed(i), F.col("__b")).bitwiseOR(i.cast("bigint")), F.lit(0).cast("bigint")))
    long = F.transform(F.when((F.col("__n") >= WINDOW) & (F.col("__n") > LONG), every).otherwise(none),
                       lambda i: F.struct(hashed(i).alias("h"), i.alias("i")))
    step = step.select(*kept, *made, "__w", "__n", "__b", F.sort_array(short).alias("__s"), F.sort_array(long).alias("__z"))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__b")) - 1).cast("int")

    def same(hashes: Column, i: Column, j: Column) -> Column:
        for k in range(WINDOW):
            hashes = hashes & (F.get("__w", i + k) == F.get("__w", j + k))
        return F.coalesce(hashes, F.lit(False))

    def alike(x: Column, y: Column) -> Column:
        return same(F.call_function("shiftright", x.bitwiseXOR(y), F.col("__b")) == 0, place(x), place(y))

    def equal(x: Column, y: Column) -> Column:
        return same(x["h"] == y["h"], x["i"], y["i"])

    def beside(rows: str, test) -> Column:
        return F.filter(rows, lambda x, i: test(x, F.get(rows, i + 1)) | ((i > 0) & test(x, F.get(rows, F.greatest(i - 1, F.lit(0))))))

    found = F.concat(F.transform(beside("__s", alike), place), F.transform(beside("__z", equal), lambda x: x["i"]))
    step = step.select(*kept, *made, "__n", F.sort_array(found).alias("__p"))
    gaps = F.zip_with(F.slice("__p", 2, F.size("__p")), F.slice("__p", 1, F.size("__p") - 1),
                      lambda b, a: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda s, g: s + g)
    return step.select(*kept, F.col("__n").cast("bigint").alias("n_words"), *made,
                       F.when(F.size("__p") > 0, covered).otherwise(0).cast("bigint").alias("n_repeat_words"))


RATIOS = {"symbol_ratio": ("n_symbols", "n_words"), "line_ratio": ("n_dup_lines", "n_lines"),
          "repeat_ratio": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def group_key(col: str) -> Column:
    """A null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{col}`").cast("string")), F.lit(""))


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """Counts and sketches brought together by ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(r).alias(r) for r in RATIOS])


def quartiles(ratio: str) -> Column:
    """The first and third quartile of a sketch (null without rows)."""
    ranks = F.array(F.lit(0.25), F.lit(0.75))
    return F.when(F.kll_sketch_get_n_double(ratio) > 0, F.kll_sketch_get_quantile_double(F.col(ratio), ranks)).alias(ratio)


def thresholds(metrics: DataFrame) -> DataFrame:
    """(lang, source, low_*, high_*) for every group of ``metrics`` (a table
    with keys ``__lang`` and ``__source``, metrics and ``base_failed``)."""
    fine = ~F.col("base_failed")
    # A row per task and group first: the lane is the task's number.
    lane = metrics.withColumn("__lane", F.spark_partition_id() % LANES).groupBy("__lang", "__source", "__lane").agg(
        F.count_if(fine).alias("n"), *[F.kll_sketch_agg_double(F.when(fine, F.try_divide(F.col(a), F.col(b))), F.lit(K)).alias(r)
                                       for r, (a, b) in RATIOS.items()])
    own = merged(lane, "__lang", "__source")
    sketches = written(own, "sketches")
    lang = merged(sketches, "__lang")
    whole = merged(lang)
    own, lang, whole = (df.select(*keys, F.struct("n", *[quartiles(r) for r in RATIOS]).alias(name)) for df, keys, name in (
        (sketches, ["__lang", "__source"], "own"), (lang, ["__lang"], "lang"), (whole, [F.lit(0).alias("__one")], "all")))
    own = own.join(lang, "__lang").withColumn("__one", F.lit(0)).join(F.broadcast(whole), "__one")   # ``whole`` is one row
    picked = F.when(F.col("own.n") >= LEAST, F.col("own")).when(F.col("lang.n") >= LEAST, F.col("lang")).otherwise(F.col("all"))
    own = own.select("__lang", "__source", picked.alias("q"))
    bounds = []
    for r in RATIOS:
        low, high = F.col(f"q.{r}")[0], F.col(f"q.{r}")[1]
        reach = F.greatest(FENCE * (high - low), F.lit(SLACK[r]))
        bounds += [(low - reach).alias(f"low_{r}"), (high + reach).alias(f"high_{r}")]
    return own.select("__lang", "__source", *bounds)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, metrics, base_failed and kept."""
    slim = docs.select(F.col(f"`{id_col}`").alias("__id"), group_key(lang).alias("__lang"),
                       group_key(source).alias("__source"), F.col(f"`{text}`").alias("__text"))
    metrics = written(text_metrics(slim, "__text").withColumn("base_failed", base_failed()), "metrics")
    limits = written(thresholds(metrics), "thresholds")
    limits = F.broadcast(limits) if limits.count() <= SMALL else limits
    fits = F.lit(True)
    for r, (a, b) in RATIOS.items():
        value = F.try_divide(F.col(a), F.col(b))
        fits = fits & F.coalesce(value.between(F.col(f"low_{r}"), F.col(f"high_{r}")), F.lit(True))
    return metrics.join(limits, ["__lang", "__source"]).select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & fits).alias("kept"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


def limits_sql() -> str:
    """Lower and upper bound of each ratio from its level's quartiles."""
    out = []
    for r in RATIOS:
        low, high = (f"CASE WHEN own.n >= {LEAST} THEN own.{r}_{e} WHEN lang.n >= {LEAST} THEN lang.{r}_{e} ELSE whole.{r}_{e} END"
                     for e in ("low", "high"))
        reach = f"greatest({FENCE} * (({high}) - ({low})), {SLACK[r]})"
        out += [f"({low}) - {reach} AS low_{r}", f"({high}) + {reach} AS high_{r}"]
    return ", ".join(out)


QUARTILES_SQL = ", ".join(f"quantile_disc({r}, {q}) FILTER (NOT base_failed) AS {r}_{e}"
                          for r in RATIOS for q, e in ((0.25, "low"), (0.75, "high")))

OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source,
         coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE[1:-1]}]')) AS l FROM documents),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep ON rep.rid = d.rid),
f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
         {', '.join(f"CAST({a} AS DOUBLE) / nullif({b}, 0) AS {r}" for r, (a, b) in RATIOS.items())} FROM m),
own AS (SELECT lang, source, count(*) FILTER (NOT base_failed) AS n, {QUARTILES_SQL} FROM f GROUP BY lang, source),
lang AS (SELECT lang, count(*) FILTER (NOT base_failed) AS n, {QUARTILES_SQL} FROM f GROUP BY lang),
whole AS (SELECT {QUARTILES_SQL} FROM f),
lim AS (SELECT own.lang, own.source, {limits_sql()} FROM own JOIN lang ON lang.lang = own.lang, whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(f"coalesce({r} BETWEEN low_{r} AND high_{r}, true)" for r in RATIOS)} AS kept
FROM f JOIN lim ON lim.lang = f.lang AND lim.source = f.source
"""
