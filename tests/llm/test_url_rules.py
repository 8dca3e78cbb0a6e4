import random
import re

import duckdb
from llm_cases import save

from botsieve.llm import url_rules as u


def slow(url, rules):
    """(host, path, site rule, verdict) by running every rule."""
    url = url or ""
    m = re.search("://([^/?#]*)([^?#]*)", url)
    host, path = (u.ascii_lower(m[1]), m[2]) if m else ("", "")
    best = None
    for r in rules:
        seen = host + path if r.site else u.ascii_lower(url)
        if re.search(r.expression, seen):
            best = max(best or (False, -1, "", ""), (r.site, r.length, r.name, r.verdict))
    return host, path, best[2] if best and best[0] else None, best[3] if best else u.DEFAULT


URLS = ["http://a.example.org/es/x", "https://example.org/en/123?x=1", "http://EXAMPLE.ORG/en/1", "http://notexample.org/es/",
        "http://example.org", "http://example.org?x=/es/", "http://b.example.com/de/5#t", "http://b.example.com/DE/5",
        "http://b.example.com/fr/", "//b.example.com/fr/", "ftp://x.com:80/fr/1", "http://u@x.com/fr/1", "", None, None,
        "http://", "x://y://z.org/", "http://shop.net/cart?x", "http://shop.net/cartoon", "http://x.net/a.EXE",
        "http://x.net/?sid=0123456789abcdef", "http://x.net/wp-admin/", "http://x.org/wp-admin/", "http://日本.org/é?ü",
        "http://exampleorg/", "http://org/", "http://.org/", "http://x.net/" + "a/" * 20_000 + "cart/"]


def test_edge_cases_and_brute_force(spark, tmp_path):
    rnd = random.Random(7)
    parts = ["http://", "https://", "example", ".", "org", "com", "net", "/", "en", "es", "de", "fr", "1", "?", "#", "A", "cart"]
    urls = URLS + URLS[:4] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(800)]
    rows = [(i, url, "clash", "clash") for i, url in enumerate(urls)] + [(None, URLS[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, token string")
    rules = u.production_rules()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in u.op6(spark, save(tmp_path, pages=pages)).collect())
    want = sorted((str(i), h, p, str(r), v) for i, url, *_ in rows for h, p, r, v in [slow(url, rules)])
    assert got == want
    assert u.op6(spark, save(tmp_path / "none", pages=pages.limit(0))).count() == 0


def test_verdicts_of_the_contract(spark, tmp_path):
    """Each site rule's word as the contract lists it, written out here, for the query and its SQL."""
    want = {"http://a.org/x": ("org/", "allow"), "http://example.org/es/x": ("example.org/es/", "block"),
            "http://w.example.org/en/12": ("example.org/en/1", "block"), "http://example.org/en/2": ("org/", "allow"),
            "http://a.com/fr/x": ("com/fr/", "allow"), "http://a.com/de/x": ("com/de/", "block")}
    pages = spark.createDataFrame(list(enumerate(want)), "page_id bigint, url string")
    folder = save(tmp_path, pages=pages)
    got = {r.page_id: (r.rule, r.verdict) for r in u.op6(spark, folder).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    rows = con.execute(f"SELECT page_id, rule, verdict FROM ({u.OP6_SQL}) ORDER BY page_id").fetchall()
    assert [tuple(r[1:]) for r in rows] == list(want.values())


def test_general_rules_and_shuffled_index(spark, monkeypatch):
    """Hosts without a path, rules without a whole token, regular expression
    signs in rules, and an index too long to be broadcast."""
    rules = [u.site_rule("a.org", "", "block"), u.site_rule("", "/x", "block"), u.site_rule("b+c.org", "/d(e)", "block"),
             u.pattern_rule("long", "zzz[0-9]+", (), "block")]
    urls = ["http://a.org/1", "http://w.a.org", "http://a.organic/", "http://aa.org/", "http://q/xyz", "http://b+c.org/d(e)f",
            "http://bbc.org/de", "http://r/zzz12", "http://q.b+c.org/d(e)"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    want = [slow(url, rules)[2:] for url in urls]
    for few, most in ((u.FEW, u.SMALL), (0, u.SMALL), (0, 0)):
        monkeypatch.setattr(u, "FEW", few)
        monkeypatch.setattr(u, "SMALL", most)
        rows = {r.page_id: (r.rule, r.verdict) for r in u.judge(pages, rules).collect()}
        assert [rows[i] for i in range(len(urls))] == want
    assert {r.verdict for r in u.judge(pages, []).collect()} == {u.DEFAULT}


def test_rarest_token_is_the_key(spark):
    urls = spark.createDataFrame([("http://x.com/rare/",), ("http://y.com/",), ("http://z.com/",)], "__url string")
    rows = {r.rule: r.token for r in u.keyed(urls, [u.site_rule("com", "/rare/", "block"), u.site_rule("com", "/rare", "allow")]).collect()}
    assert rows == {"com/rare/": "rare", "com/rare": "com"}


def test_no_shuffle_of_pages(spark):
    """With few rules the only exchange is that of counted tokens, before the index is there."""
    pages = spark.createDataFrame([(i, url) for i, url in enumerate(URLS)], "page_id bigint, url string")
    plan = u.judge(pages, u.production_rules())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
