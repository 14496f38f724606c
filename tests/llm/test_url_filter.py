import re

from classmap.llm import url_filter
from classmap.llm.queries import RULES

URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG", "https://example.org/", "https://a.example.org/en/1?x",
    "https://example.org/en/2", "https://example.org/es/9#t", "https://notexample.org/es/", "ftp://x.com/de/1",
    "ftp://x.com/fr/1", "//x.com/de/", "http://com/de/", "http://xcom/de/", "http://a.net/free-casino", "http://a.net/free/free",
    "http://porn.net/", "http://pornography.net/", "http://é.net/éxxx", "http://a.net/xxx1", "http://a.net/a_xxx_b",
    "http://a.net/?q=http://b.com/de/", "http://a.net\n/de/poker bet", "http://SPAM-farm.net/ok?bet#poker", "http://a.net/xxx-xxx",
    "http://a.com?d=/de/", "http://a.com/de", "http://user@b.org:80/en/1", "http://a.net/" + "bet " * 50_000,
]


def brute(url):
    text = url or ""
    after = text.split("://", 1)[1] if "://" in text else ""
    host = re.split(r"[/?#]", after)[0]
    path = re.split(r"[?#]", after[len(host) :])[0]
    lower = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    host, low = lower(host), lower(text)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name)) if fits else None
    hits = {t: len(re.findall(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in url_filter.VOCABULARY.strict + url_filter.VOCABULARY.soft}
    strict = sum(hits[t] for t in url_filter.VOCABULARY.strict)
    soft = sum(hits[t] > 0 for t in url_filter.VOCABULARY.soft)
    own = "block" if strict or soft >= 2 else "allow"
    return host, path, rule and rule.name, rule.verdict if rule else own, strict, soft


def test_matches_brute_force(spark):
    rows = [(i if i % 7 else None, u, "h") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string").selectExpr("*", "'x' as address", "1 as verdict", "2 as fit")
    found = url_filter.judge_urls(pages.repartition(3), RULES).collect()
    want = [(i, *brute(u)) for i, u, _ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_longest_rule_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.example.org/en/17"), (2, "http://x.org/en/1")], "page_id bigint, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, RULES).collect()}
    assert got == {1: ("example.org/en/1", "block"), 2: ("org/", "allow")}


def test_empty_table_and_vocabulary(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge_urls(pages, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://porn.net/")], pages.schema)
    (row,) = url_filter.judge_urls(one, (), url_filter.Vocabulary((), ())).collect()
    assert (row["verdict"], row["rule"]) == ("allow", None)
