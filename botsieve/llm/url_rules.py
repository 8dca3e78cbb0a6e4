"""URL verdicts by pattern rules that are indexed by their rarest token.

*Rules.* A site rule has a host, a path prefix and a verdict; it fits its host
and all subdomains, and the longest fitting rule wins. A pattern rule is a
regular expression over the lower-cased URL with the literal tokens any match
must have; patterns give the verdict where no site rule fits, else it is
``DEFAULT``.

*Index.* A token is a run of letters a-z and digits. Of a rule's literal
tokens (only those that are whole tokens in any URL it fits) the one that is
rarest in the given URLs becomes its key; one counting pass over the URLs
finds it. URLs are split into tokens, the tokens fetch candidate rules, and
regular expressions run on candidates only. Rules without a whole token hang on
the empty token, which every URL has. Up to ``FEW`` rules the index is a map
that goes with the plan, so a URL is judged in its row and nothing is shuffled.
Beyond, tokens and rules are joined, by a broadcast up to ``SMALL`` rules and
then by a shuffle whose skewed tokens Spark splits; what a URL's candidates gave
is combined per row, first in the task that fetched them.

Defined results: a null URL, or one without ``://``, has an empty host and
path and fits no site rule; repeated rows are judged each; ties of equal
length go to the later name; without rules everything gets ``DEFAULT``; other
columns are not read.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table

FEW, SMALL = 1000, 200_000     # rules in a map; rules that may be broadcast
DEFAULT = "allow"
HOST, PATH = "://([^/?#]*)", "://[^/?#]*([^?#]*)"
TOKEN = "[a-z0-9]+"

# The site rules (host, path, verdict) ...
SITES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# ... and the patterns (name, expression, literal tokens, verdict).
PATTERNS = (("admin", "/(wp-)?admin/", ("admin",), "block"),
            ("session", "[?&]phpsessid=[0-9a-f]{16}", ("phpsessid",), "block"),
            ("session", "[?&]sid=[0-9a-f]{16}", ("sid",), "block"),
            ("calendar", "/calendar/[0-9]{4}/", ("calendar",), "block"),
            ("cart", "/cart([/?]|$)", ("cart",), "block"),
            ("program", "[.]exe$", ("exe",), "block"),
            ("program", "[.]zip$", ("zip",), "block"),
            ("program", "[.]iso$", ("iso",), "block"))


@dataclass(frozen=True)
class Rule:
    name: str
    expression: str        # over host and path (site) or over the lower-cased URL
    tokens: tuple
    verdict: str
    site: bool
    length: int


def lowered(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def ascii_lower(text: str) -> str:
    return text.translate(str.maketrans(UPPER, LOWER))


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """The host begins at a label and is followed by the path; the path's last
    token may go on in the URL, so it is no key unless something ends it."""
    host = ascii_lower(host)
    tokens = re.findall(TOKEN, ascii_lower(path))
    if tokens and not re.search(f"(?!{TOKEN}).$", ascii_lower(path), re.S):
        tokens.pop()
    end = "" if path else "(?=/|$)"
    return Rule(host + path, r"^([^/]*[.])?" + re.escape(host + path) + end, (*re.findall(TOKEN, host), *tokens), verdict,
                True, len(host + path))


def pattern_rule(name: str, expression: str, tokens: tuple, verdict: str) -> Rule:
    return Rule(name, expression, tuple(tokens), verdict, False, len(expression))


def url_tokens(url: str) -> Column:
    found = F.regexp_extract_all(lowered(F.col(url)), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.concat(F.array(F.lit("")), F.coalesce(found, F.array().cast("array<string>"))))


def keyed(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules as a table, each with its rarest token in ``urls.__url``."""
    spark = urls.sparkSession
    rows = [(t, *(getattr(r, f) for f in ("name", "expression", "verdict", "site", "length")), i)
            for i, r in enumerate(rules) for t in (r.tokens or ("",))]
    listed = spark.createDataFrame(rows, "token string, rule string, expression string, verdict string, site boolean, "
                                         "length int, number int")
    wanted = listed.select("token").distinct()
    wanted = F.broadcast(wanted) if len(rows) <= SMALL else wanted
    seen = urls.select(F.explode(url_tokens("__url")).alias("token")).join(wanted, "token", "left_semi")
    seen = seen.groupBy("token").count()
    ranked = listed.join(seen, "token", "left").groupBy("number").agg(F.min_by(
        F.struct("token", "rule", "expression", "verdict", "site", "length"),
        F.struct(F.coalesce("count", F.lit(0)), "token")).alias("r"))
    return ranked.select("r.*")


def best_of_map(index: list) -> Column:
    """The best fitting rule of a row, struct(site, length, rule, verdict), from an
    index held as a map of tokens."""
    held: dict[str, list] = {}
    for r in index:
        held.setdefault(r.token, []).append(F.struct(*[F.lit(r[c]).alias(c) for c in ("site", "length", "rule", "verdict", "expression")]))
    rules = F.create_map(*[x for token, rows in held.items() for x in (F.lit(token), F.array(*rows))])
    known = F.array_intersect(url_tokens("__url"), F.array(*map(F.lit, held)))
    asked = F.flatten(F.transform(known, lambda t: F.element_at(rules, t)))
    site, url = F.concat("__host", "__path"), lowered(F.coalesce("__url", F.lit("")))
    fit = F.filter(asked, lambda r: F.regexp_like(F.when(r["site"], site).otherwise(url), r["expression"]))
    return F.array_max(F.transform(fit, lambda r: F.struct(r["site"], r["length"], r["rule"], r["verdict"])))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: id, host, path, the site rule that fits (or null), the
    pattern that fits (or null; only where no site rule does) and the verdict."""
    slim = pages.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url}`").alias("__url"))
    slim = slim.withColumn("__row", F.monotonically_increasing_id())
    text = F.coalesce("__url", F.lit(""))
    slim = slim.withColumn("__host", lowered(F.regexp_extract(text, HOST, 1))).withColumn("__path", F.regexp_extract(text, PATH, 1))
    keys = ["__row", "__id", "__host", "__path"]
    if rules and len(rules) <= FEW:
        found = slim.select(*keys, best_of_map(keyed(slim, rules).collect()).alias("b"))
    elif rules:
        index = keyed(slim, rules)
        index = F.broadcast(index) if len(rules) <= SMALL else index
        asked = slim.withColumn("token", F.explode(url_tokens("__url"))).join(index, "token", "left")
        # One expression per candidate, over the text its kind looks at.
        seen = F.when(F.col("site"), F.concat("__host", "__path")).otherwise(lowered(F.coalesce("__url", F.lit(""))))
        fits = F.coalesce(F.regexp_like(seen, F.col("expression")), F.lit(False))
        best = F.max(F.when(fits, F.struct("site", "length", "rule", "verdict")))
        found = asked.groupBy(*keys).agg(best.alias("b"))
    else:
        found = slim.select(*keys, F.lit(None).cast("struct<site:boolean,length:int,rule:string,verdict:string>").alias("b"))
    return found.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
                        F.when(F.col("b.site"), F.col("b.rule")).alias("rule"),
                        F.when(~F.col("b.site"), F.col("b.rule")).alias("pattern"),
                        F.coalesce("b.verdict", F.lit(DEFAULT)).alias("verdict"))


def production_rules() -> list[Rule]:
    return [*(site_rule(*s) for s in SITES), *(pattern_rule(*p) for p in PATTERNS)]


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, production_rules()).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '{HOST}', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path FROM pages),
r(host, path, verdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in SITES)}),
fit AS (
  SELECT rid, r.host || r.path AS rule, r.verdict AS verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) AS k
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, CASE
  {' '.join(f"WHEN regexp_matches(translate(url, '{UPPER}', '{LOWER}'), '{e}') THEN '{v}'" for _, e, _, v in PATTERNS)}
  ELSE '{DEFAULT}' END) AS verdict
FROM u LEFT JOIN fit ON fit.rid = u.rid AND fit.k = 1
"""
