import pytest

from repopulse.llm import urls as U

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "Example.ORG", "/en/1"),
    ("allow", "a.example.org", "/en/1"),
    ("allow", "com", ""),
    ("block", "com", "/x"),
    ("block", "com", "/x"),
    ("allow", "com", "/x"),
    ("block", "b.com", "/é"),
    ("block", "", "/empty"),
    ("block", None, "/"),
]


def by_hand(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, rule_host, rule_path in rules:
        if rule_host is None:
            continue
        rule_host = rule_host.lower()
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            best = max(best or (0,), (len(rule_host + rule_path), len(rule_host), rule_host + rule_path, verdict))
    return host, path, best and best[2], best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///p", "x://ORG", "https://example.org", "https://example.org/",
    "https://Example.org/es/x?y=/en/1#z", "http://a.example.org/en/17", "http://b.a.example.org/en/1",
    "http://myexample.org/es/", "http://a.com/xyz", "http://b.com/éa/x", "http://com", "http://a.com?/x", "ftp://u@h.org:80/#/es/",
    "http://a..org/", "http://x.org/http://example.org/es/", "http://q.net/" + "a/" * 5000, "http:///empty/a",
    "http://" + "s." * 300 + "com/x", "http://é.org/\n/x",
]


def test_rules_equal_those_by_hand(spark):
    rows = [(k, url) for k, url in enumerate(URLS)] + [(0, None), (None, URLS[8])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "url as html", "url as host", "url as path", "page_id as row", "url as rule", "url as digest"
    )
    found = U.judged(pages, U.rule_table(spark, RULES))
    expected = [(k, *by_hand(url, RULES)) for k, url in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("short", [1, 8])
def test_short_hashes_that_meet_are_told_apart(spark, monkeypatch, short):
    monkeypatch.setattr(U, "SHORT", short)
    rules = [("block", f"h{k}.net", f"/{k}") for k in range(60)]
    rows = [(k, f"http://w.h{k % 70}.net/{k % 60}") for k in range(300)]
    found = U.judged(spark.createDataFrame(rows, "page_id long, url string"), U.rule_table(spark, rules), "neither")
    assert sorted(map(tuple, found.collect())) == sorted((k, *by_hand(url, rules, "neither")) for k, url in rows)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = U.rule_table(spark)
    assert U.judged(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in U.judged(pages, rules.limit(0)).collect()] == [(1, "a.org", "/x", None, "allow")]
