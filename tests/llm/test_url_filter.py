import random

import pytest

from lakeops.llm.url_filter import RULES, judge_urls


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = path = ""
    if rest is not None:
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h.count(".") + 1, len(p), v, h + p) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "https://a.example.com/en/725?x=/de/", "https://example.com/en/6", "https://notexample.com/en/7", "http://com/en/", "http://x.com/en",
        "http://b.net/de/", "http://b.example.net/de/8#f", "http://b.example.net/de/7/8", "http://org/es/1?q", "http://é.org/es/\n2", "http://a.b.com:80/en/", "x://y://org/es/", "http://.com/en/7", "http://ÀB.ORG/es/"]


def check(spark, urls, rules, **kw):
    rows = list(enumerate(urls))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules, **kw).collect()}
    assert got == {i: brute(u, rules) for i, u in rows}


def test_trie_and_join_match_brute_force(spark):
    r = random.Random(2)
    hosts = [".".join(r.choice("ab") for _ in range(r.randrange(1, 4))) for _ in range(40)]
    paths = ["/".join(["", *(r.choice(["", "x", "xy", "xyz"]) for _ in range(r.randrange(4)))]) for _ in range(40)]
    rules = [(r.choice(["allow", "block"]), r.choice(hosts), r.choice(paths)) for _ in range(60)]
    urls = URLS + [f"http://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?q', '#f'])}" for _ in range(300)]
    for kw in ({}, {"most_rules": 0}):
        check(spark, urls, RULES, **kw)
        check(spark, urls, rules, **kw)


def test_empty_table_and_extra_columns(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0
    rows = [(1, "http://x.org/es/", "h", "r"), (1, "http://x.org/es/", "h", "r"), (None, None, None, None)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, rule string"), RULES).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in got if r.rule) == [(1, "org/es/", "block")] * 2 and len(got) == 3


@pytest.mark.parametrize("rule", [("block", "a.com", "en/"), ("block", "", "/en"), ("forbid", "a.com", ""), ("block", "A.com", ""), ("allow", "a.com/x", ""), ("allow", "a.com", "/x?y")])
def test_malformed_rules_are_errors_in_both_forms(spark, rule):
    for kw in ({}, {"most_rules": 0}):
        with pytest.raises(ValueError, match="not a rule"):
            judge_urls(spark.createDataFrame([(1, "http://a.com/en/x")], "page_id long, url string"), [rule], **kw)
