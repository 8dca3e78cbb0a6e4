"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
``://`` and identifier cues (``password``, ``token``, ``AKIA``, ``IBAN`` ...).
From each anchor a local parser walks to the left and right over the characters
its kind allows, checks what it found (four parts up to 255, Luhn, digit
counts, IBAN check digits) and gives a span. Nothing is searched between
anchors, so the cost of a text without anchors is the automaton's pass.

Kinds: ``email``, ``ip``, ``card``, ``phone`` (the base kinds, leftmost and
non-overlapping per kind, equal to the contract's patterns), and two that cues
add: ``login`` (user and password of a URL) and ``account`` (keys, passwords,
account numbers, IBANs). An added span that overlaps a base span is left out.

Spans count code points, end exclusive. Defined results: null and empty texts
have no spans; equal texts get equal spans; invalid UTF-8 counts as
replacement characters; other columns play no part. Long texts take linear
time: a run that many cues share is walked once (``Values``), and every other
parser stops at the next anchor of its kind or after a fixed number of letters.
"""

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_udf, struct_array, table, utf8

KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE = KINDS[:4]

# The characters of the contract's patterns.
DIGITS = frozenset("0123456789")
ALNUM = DIGITS | frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
DIAL = DIGITS | frozenset(" ().-")
SECRET = ALNUM | frozenset("_-./+=")

# Cues, and how what follows them is read.
VALUE_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "api-key")
NUMBER_CUES = ("account", "acct")
LEAST_VALUE, LEAST_NUMBER, GAP = 8, 8, 8


def run_end(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of ``allowed`` characters from ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around an at-sign; the local part begins at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        stop = run_end(text, end + 1, LABEL)
        if stop == end + 1:
            break
        end, labels = stop, labels + 1
    return (start, end) if labels else None


def ip_at(text: str, at: int) -> tuple[int, int, bool]:
    """Four dotted numbers from the digit at ``at`` on: (start, end, valid);
    with fewer, the end of the chain and not valid."""
    start, parts, end = at, [], at
    while True:
        stop = run_end(text, end, DIGITS)
        parts.append(text[end:stop])
        if len(parts) == 4:
            small = (p.lstrip("0") for p in parts)
            return start, stop, all(len(p) < 3 or len(p) == 3 and p <= "255" for p in small)
        if not (stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in DIGITS):
            return start, stop, False
        end = stop + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def card_at(text: str, at: int) -> tuple[int, int, bool]:
    """Digits with single spaces or hyphens between them: (start, end, valid)."""
    end, n = run_end(text, at, DIGITS), len(text)
    while end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
        end = run_end(text, end + 1, DIGITS)
    digits = text[at:end].replace(" ", "").replace("-", "") if end - at < 64 else ""
    return at, end, 14 <= len(digits) <= 19 and luhn(digits)


def phone_at(text: str, at: int) -> tuple[int, int, bool] | None:
    """From a plus sign on: (start, end, valid)."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, DIAL)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    count = sum(c in DIGITS for c in text[at:end]) if end - at < 64 else sum(map(text[at:end].count, DIGITS))
    return at, end, 10 <= count <= 15


def login_at(text: str, at: int) -> tuple[int, int] | None:
    """``user:password`` between ``://`` (which ends before ``at``) and an at-sign."""
    user = run_end(text, at, LOCAL)
    if user == at or user >= len(text) or text[user] != ":":
        return None
    end = run_end(text, user + 1, SECRET)
    return (at, end) if end > user + 1 and end < len(text) and text[end] == "@" else None


class Values:
    """Runs of secret characters of one text, each walked once: cues may lie
    inside a run by the thousand, and all of them share its end and digits."""

    def __init__(self, text: str):
        self.text = text
        self.start = self.stop = self.end = self.digit = 0   # run, its end without dots, its last digit

    def find(self, at: int) -> tuple[int, bool]:
        """Where the value from ``at`` ends, and whether it has a digit."""
        if not self.start <= at < self.stop:
            text = self.text
            self.start, self.stop = at, run_end(text, at, SECRET)
            self.end = self.stop
            while self.end > at and text[self.end - 1] == ".":
                self.end -= 1
            self.digit = self.end - 1
            while self.digit >= at and text[self.digit] not in DIGITS:
                self.digit -= 1
        return max(at, self.end), self.digit >= at


def value_after(text: str, at: int, values: Values) -> tuple[int, int] | None:
    """A quoted or bare value after ``=`` or ``:``."""
    at = run_end(text, at, frozenset(" "))
    if at >= len(text) or text[at] not in "=:":
        return None
    at = run_end(text, at + 1, frozenset(" "))
    if at < len(text) and text[at] in "\"'":
        at += 1
    end, has_digit = values.find(at)
    return (at, end) if end - at >= LEAST_VALUE and has_digit else None


def number_after(text: str, at: int) -> tuple[int, int] | None:
    """A run of digits at most ``GAP`` characters after the cue."""
    for i in range(at, min(at + GAP, len(text))):
        if text[i] in DIGITS:
            end = run_end(text, i, DIGITS)
            return (i, end) if end - i >= LEAST_NUMBER else None
    return None


def iban_after(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN with valid check digits, in groups or not, after the cue."""
    at = run_end(text, at, frozenset(" :"))
    end, body, head, rest = at, "", 0, 0
    while end < len(text) and len(body) < 34 and (text[end] in ALNUM or text[end] == " "):
        c = text[end]
        end += 1
        if c == " ":
            continue
        body += c
        value = int(c, 36)
        if len(body) <= 4:      # country and check digits go to the end of the number
            if (value < 10) == (len(body) <= 2):
                return None
            head = head * (100 if value > 9 else 10) + value
            continue
        rest = (rest * (100 if value > 9 else 10) + value) % 97
        if len(body) >= 15 and (rest * 1_000_000 + head) % 97 == 1 and not (end < len(text) and text[end] in ALNUM):
            return at, end
    return None


def key_at(text: str, at: int) -> tuple[int, int] | None:
    """An access key id: its four-letter prefix ends before ``at``."""
    end = at + 16
    if len(text) < end or run_end(text[at:end + 1], 0, ALNUM) != 16:   # one more would be another key
        return None
    return (at - 4, end) if text[at:end].upper() == text[at:end] else None


def anchors():
    """The automaton: each anchor with the name of its parser and its length."""
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "email"), ("+", "phone"), ("://", "login"), ("AKIA", "key"),
                       *((d, "digit") for d in sorted(DIGITS))):
        found.add_word(sign, kind)
    for cues, kind in ((VALUE_CUES, "value"), (NUMBER_CUES, "number"), (("iban",), "iban")):
        for cue in cues:
            for form in {cue, cue.title(), cue.upper()}:
                found.add_word(form, kind)
    found.make_automaton()
    return found


ADDED = {"login": ("login", login_at), "key": ("account", key_at), "number": ("account", number_after),
         "iban": ("account", iban_after)}


def spans_of(text: str, automaton) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) of every span, sorted."""
    base, added, values = [], [], Values(text)
    done = {"email": 0, "ip": 0, "card": 0, "phone": 0}   # where each kind's next match may begin
    for last, kind in automaton.iter(text):
        if kind == "digit":
            if last >= done["ip"]:
                start, end, valid = ip_at(text, last)
                done["ip"] = end
                if valid:
                    base.append((start, 1, end))
            if last >= done["card"]:
                start, end, valid = card_at(text, last)
                done["card"] = end
                if valid:
                    base.append((start, 2, end))
        elif kind == "email":
            if found := email_at(text, last, done["email"]):
                base.append((found[0], 0, found[1]))
                done["email"] = found[1]
        elif kind == "phone":
            if last >= done["phone"] and (found := phone_at(text, last)):
                done["phone"] = found[1]
                if found[2]:
                    base.append((found[0], 3, found[1]))
        elif kind == "value":
            if found := value_after(text, last + 1, values):
                added.append((found[0], KINDS.index("account"), found[1]))
        else:
            name, parse = ADDED[kind]
            if found := parse(text, last + 1):
                added.append((found[0], KINDS.index(name), found[1]))
    if added:
        reach, free, i = 0, [], 0
        taken = sorted((a, b) for a, _, b in base)   # spans of one kind never overlap
        for a, k, b in sorted(set(added)):
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if a >= reach and (i == len(taken) or taken[i][0] >= b):
                free.append((a, k, b))
                reach = b
        base += free
    return sorted(base)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def span_column(text: str | Column) -> Column:
    """array<struct<kind, start, end>> of a text column."""
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def make():
        automaton = anchors()

        def run(texts):
            return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(
                (t.as_py() or b"").decode("utf-8", "replace"), automaton)] for t in texts], pa.list_(one))
        return run
    return batch_udf(make, "array<struct<kind:string,start:bigint,end:bigint>>")(utf8(text))


def digest_column(text: str | Column) -> Column:
    """Counts and digest of the base spans, and all spans as text."""
    kinds = [*((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string())]

    def make():
        automaton = anchors()

        def run(texts):
            rows = []
            for t in texts:
                spans = spans_of((t.as_py() or b"").decode("utf-8", "replace"), automaton)
                base = [s for s in spans if s[1] < len(BASE)]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*(sum(s[1] == k for s in base) for k in range(len(BASE))), digest, listed(spans)))
            return struct_array(kinds, [[r[i] for r in rows] for i in range(len(kinds))])
        return run
    return batch_udf(make, ", ".join(f"{n} {'bigint' if n[:2] == 'n_' else 'string'}" for n, _ in kinds))(utf8(text))


def masked_column(text: str | Column) -> Column:
    """The text with every span replaced by its kind, as ``<EMAIL>``; of spans
    that overlap, the first replaces them all. A null text stays null."""
    def make():
        automaton = anchors()

        def run(texts):
            out = []
            for t in texts:
                value = t.as_py()
                if value is not None:
                    value = value.decode("utf-8", "replace")
                    kept, at, name = [], 0, None
                    for a, k, b in spans_of(value, automaton):
                        if a >= at:
                            kept += [value[at:a], f"<{KINDS[k].upper()}>"]
                        at = max(at, b)
                    value = "".join([*kept, value[at:]])
                out.append(value)
            return pa.array(out, pa.string())
        return run
    col = F.col(text) if isinstance(text, str) else text
    return batch_udf(make, "string")(col.cast("binary"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind."""
    return docs.withColumn(text, masked_column(text))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", digest_column("text").alias("d"))
    return out.select("doc_id", *[f"d.n_{k}" for k in BASE], "d.base_sha256", "d.spans")


def forms_sql(cues: tuple) -> str:
    return "|".join(dict.fromkeys(f for c in cues for f in (c, c.title(), c.upper())))


SECRET_SQL = r"[A-Za-z0-9_\-./+=]+"
# Kind and pattern: where a match begins and ends in the text. Each pattern's
# matches are found without overlaps, so two cues inside one value may differ
# from the parsers, which try every cue; the tests cover those by hand.
FOUND_SQL = ((0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), (1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
             (2, r"[0-9](?:[\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]"),
             (4, r"://[A-Za-z0-9._%+-]+:" + SECRET_SQL + "@"), (5, "AKIA[A-Za-z0-9]+"),
             (6, f"(?:{forms_sql(VALUE_CUES)}) *[=:] *[\"'']?{SECRET_SQL}"), (7, f"(?:{forms_sql(NUMBER_CUES)})[^0-9]{{0,{GAP - 1}}}[0-9]+"),
             (8, f"(?:{forms_sql(('iban',))})[ :]*[A-Za-z0-9 ]+"))

# Luhn, and the IBAN remainder of the first n characters, by list functions.
LUHN_SQL = ("list_sum(list_transform(range(1, length(digits) + 1), lambda i: CAST(digits[length(digits) + 1 - i] AS INTEGER) "
            "* (CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END) - CASE WHEN i % 2 = 0 AND digits[length(digits) + 1 - i] > '4' THEN 9 ELSE 0 END)) % 10 = 0")
MOD97_SQL = ("list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(string_split(upper(replace(substr(v, 5, n - 4) || substr(v, 1, 4), ' ', '')), ''), "
             "lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))), "
             "lambda a, c: (a * (CASE WHEN c > 9 THEN 100 ELSE 10 END) + c) % 97) = 1")

OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lists AS (
  {' UNION ALL '.join(f"SELECT rid, {k} AS k, regexp_extract_all(text, '{x}') AS ms, string_split_regex(text, '{x}') AS gs FROM d" for k, x in FOUND_SQL)}),
places AS (
  SELECT rid, k, ms[i] AS m,
         list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT rid, k, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM lists)),
base AS (
  SELECT rid, k, a, a + length(m) AS b FROM (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM places WHERE k < 4)
  WHERE CASE k WHEN 1 THEN list_max(list_transform(string_split(m, '.'), lambda x: CASE WHEN length(ltrim(x, '0')) > 3 THEN 999
                             WHEN ltrim(x, '0') = '' THEN 0 ELSE CAST(ltrim(x, '0') AS INTEGER) END)) <= 255
             WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND {LUHN_SQL}
             WHEN 3 THEN length(digits) BETWEEN 10 AND 15 ELSE true END),
-- What the parsers take of a cue's match: its text and the characters before.
value AS (
  SELECT rid, k, m, a, CASE k WHEN 4 THEN substr(m, 4, length(m) - 4) WHEN 5 THEN m
    WHEN 6 THEN rtrim(regexp_extract(m, '^[A-Za-z_-]+ *[=:] *["'']?(.*)$', 1), '.') WHEN 7 THEN regexp_extract(m, '[0-9]+$')
    ELSE regexp_extract(m, '^[A-Za-z]{{4}}[ :]*(.*)$', 1) END AS v,
    CASE k WHEN 4 THEN 3 WHEN 5 THEN 0 WHEN 6 THEN length(regexp_extract(m, '^[A-Za-z_-]+ *[=:] *["'']?'))
    WHEN 7 THEN length(m) - length(regexp_extract(m, '[0-9]+$')) ELSE length(regexp_extract(m, '^[A-Za-z]{{4}}[ :]*')) END AS skip
  FROM places WHERE k > 3),
iban AS (
  SELECT rid, a, skip, min(n) AS n FROM (
    SELECT rid, a, skip, v, unnest(range(15, length(v) + 1)) AS n FROM value WHERE k = 8)
  WHERE length(replace(substr(v, 1, n), ' ', '')) BETWEEN 15 AND 34 AND substr(v, n, 1) <> ' ' AND regexp_matches(v, '^[A-Za-z]{{2}}[0-9]{{2}}')
    AND {MOD97_SQL} AND NOT regexp_matches(substr(v, n + 1, 1), '[A-Za-z0-9]') GROUP BY rid, a, skip),
added AS (
  SELECT DISTINCT rid, CASE k WHEN 4 THEN 4 ELSE 5 END AS k, a + skip AS a, a + skip + length(v) AS b FROM value
  WHERE CASE k WHEN 4 THEN true WHEN 5 THEN length(v) = 20 AND upper(v) = v
             WHEN 6 THEN length(v) >= {LEAST_VALUE} AND regexp_matches(v, '[0-9]') WHEN 7 THEN length(v) >= {LEAST_NUMBER} ELSE false END
  UNION SELECT rid, 5, a + skip, a + skip + n FROM iban),
free AS (SELECT * FROM added x WHERE NOT EXISTS (SELECT 1 FROM base y WHERE y.rid = x.rid AND y.a < x.b AND x.a < y.b)),
kept AS (
  SELECT * FROM free x WHERE NOT EXISTS (SELECT 1 FROM free y WHERE y.rid = x.rid AND y.a < x.b AND x.a < y.b AND (y.a, y.k, y.b) < (x.a, x.k, x.b))),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM kept),
listed AS (
  SELECT rid, {', '.join(f"count(*) FILTER (k = {i}) AS n_{n}" for i, n in enumerate(BASE))},
         string_agg({(name := f"{list(KINDS)}[k + 1]")} || ':' || a || ':' || b, ',' ORDER BY a, k, b) FILTER (k < 4) AS base,
         string_agg({name} || ':' || a || ':' || b, ',' ORDER BY a, k, b) AS spans FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{n}, 0) AS BIGINT) AS n_{n}" for n in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed ON listed.rid = d.rid
"""
