"""DuckDB SQL of the SimHash query: XXH64, fingerprints, all pairs, components.

Arithmetic modulo 2**64 is done in 128-bit numbers. Pairs of distinct
fingerprints are compared one by one here, which is what the query avoids.
"""

from .common import LOWER, UPPER, WORD
from .simhash import BITS, MAX_BITS, SEED, SHINGLE

# The five primes of XXH64.
P1, P2, P3, P4, P5 = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
                      2870177450012600261)
MASK = (1 << 64) - 1


def num(n: int) -> str:
    return f"{n & MASK}::UHUGEINT"


def times(x: str, prime: int) -> str:
    return f"(({x}) * {num(prime)} & {num(MASK)})"


def plus(x: str, y: str) -> str:
    return f"((({x}) + ({y})) & {num(MASK)})"


def turned(x: str, bits: int) -> str:
    """Rotated left; the list binds ``x`` to a name."""
    return f"list_transform([{x}], lambda r: (r * {num(1 << bits)} & {num(MASK)}) + (r >> {num(64 - bits)}))[1]"


def lane(acc: str, x: str) -> str:
    return times(turned(plus(acc, times(x, P2)), 31), P1)


def little(place: str, size: int) -> str:
    """Little-endian number of ``size`` bytes of the list ``b`` behind ``place``."""
    return "(" + " + ".join(f"b[{place} + {i + 1}] * {num(1 << 8 * i)}" for i in range(size)) + ")"


XXH64_SQL = f"""
coded AS (SELECT s, list_transform(regexp_extract_all(hex(encode(s)), '..'), lambda x: CAST(CAST('0x' || x AS INTEGER) AS UHUGEINT)) AS b
          FROM (SELECT DISTINCT s FROM grams)),
striped AS (
  SELECT s, b, len(b) AS n, len(b) // 32 * 32 AS o, CASE WHEN len(b) < 32 THEN NULL ELSE list_reduce(
    list_transform(range(len(b) // 32), lambda k: [{', '.join(little(f'k * 32 + {8 * j}', 8) for j in range(4))}]),
    lambda a, x: [{', '.join(lane(f'a[{j}]', f'x[{j}]') for j in range(1, 5))}],
    [{num(SEED + P1 + P2)}, {num(SEED + P2)}, {num(SEED)}, {num(SEED - P1)}]) END AS v FROM coded),
begun AS (
  SELECT s, b, n, o, (CASE WHEN v IS NULL THEN {num(SEED + P5)} ELSE list_reduce(v,
    lambda h, a: {plus(times(f"xor(h, {lane(num(0), 'a')})", P1), num(P4))},
    ({' + '.join(turned(f'v[{j}]', bits) for j, bits in ((1, 1), (2, 7), (3, 12), (4, 18)))}) & {num(MASK)}) END
    + n::UHUGEINT) & {num(MASK)} AS h FROM striped),
eights AS (
  SELECT s, b, n, o + (n - o) // 8 * 8 AS o, list_reduce(list_transform(range((n - o) // 8), lambda k: {little('o + k * 8', 8)}),
    lambda h, x: {plus(times(turned(f"xor(h, {lane(num(0), 'x')})", 27), P1), num(P4))}, h) AS h FROM begun),
fours AS (
  SELECT s, b, n, o + (n - o) // 4 * 4 AS o, list_reduce(list_transform(range((n - o) // 4), lambda k: {little('o + k * 4', 4)}),
    lambda h, x: {plus(times(turned(f"xor(h, {times('x', P1)})", 23), P2), num(P3))}, h) AS h FROM eights),
ones AS (SELECT s, list_reduce(b[o + 1:n], lambda h, x: {times(turned(f"xor(h, {times('x', P5)})", 11), P1)}, h) AS h FROM fours),
mixed AS (SELECT s, {times(f"xor(h, (h >> {num(33)}))", P2)} AS h FROM ones),
mixed_again AS (SELECT s, {times(f"xor(h, (h >> {num(29)}))", P3)} AS h FROM mixed),
hashed AS (SELECT s, CAST(xor(h, (h >> {num(32)})) AS UBIGINT) AS h FROM mixed_again)"""

OP1_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
grams AS (
  SELECT rid, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, least(len(w), 1) + 1))) AS i FROM d)),
{XXH64_SQL.strip()},
prints AS (
  SELECT d.rid, doc_id, coalesce(f, 0::UBIGINT) AS f FROM d LEFT JOIN (
    SELECT rid, {' | '.join(f"CASE WHEN 2 * sum(h >> {b}::UBIGINT & 1::UBIGINT) > count(*) THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END" for b in range(BITS))} AS f
    FROM grams JOIN hashed USING (s) GROUP BY rid) p ON p.rid = d.rid),
nodes AS (SELECT f, min(doc_id) AS least FROM prints GROUP BY f),
near AS (SELECT x.f AS a, y.f AS b FROM nodes x JOIN nodes y ON bit_count(xor(x.f, y.f)) <= {MAX_BITS}),
reach AS (SELECT f AS a, f AS b FROM nodes UNION SELECT reach.a, near.b FROM reach JOIN near ON near.a = reach.b),
classes AS (SELECT reach.a AS f, min(least) AS component_id FROM reach JOIN nodes ON nodes.f = reach.b GROUP BY reach.a)
SELECT doc_id, lpad(lower(hex(prints.f)), 16, '0') AS fingerprint, component_id FROM prints JOIN classes ON classes.f = prints.f
"""
