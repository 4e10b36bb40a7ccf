import random

import pytest

from runweave.llm import url_rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.org", "", "block"), ("a.org", "/x", "allow"), ("a.org", "/x/y", "block"), ("a.org", "/x/y", "allow"),
         ("", "", "block"), (None, "/", "block"), ("b.org", None, "block")]


def judged(url, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for h, p, verdict in RULES:
        p = p or ""
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), verdict == "block")
            if best is None or key > best[0]:
                best = (key, h + p, verdict)
    return (host, path, best[1], best[2]) if best else (host, path, None, default)


def urls(n=3000):
    rng = random.Random(6)
    hosts = ["net", "x.net", "example.net", "www.example.net", "EXAMPLE.com", "a.example.com", "org", "a.org", "b.a.org",
             "b.org", "aorg", "net-x.net", "x.net-", "", "a..org", "net:80", "u@net", "a\x01b.net", "é.org"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/", "/x", "/x/y/z", "/xy", "?q=/en/", "#/fr/", "/en/?a=/", "/é\nq"]
    out = [None, "", "no scheme", "://", "http://a.org/x/y", "http://x?y://z"]
    out += [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(n)]
    return out + ["http://hot.example.net/en/page"] * n  # one URL holds half of the rows


def test_against_every_rule(spark):
    rows = list(enumerate(urls())) + [(None, "http://x.net/"), (0, "http://x.net/")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((tuple(row) for row in url_rules.judge(pages, rules).collect()), key=str)
    assert got == sorted(((i, *judged(u)) for i, u in rows), key=str)


@pytest.mark.parametrize("pages, rules", [([], RULES), ([(1, "http://x.net/")], [])])
def test_empty_tables(spark, pages, rules):
    got = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"),
                          spark.createDataFrame(rules, "host string, path string, verdict string"), "block").collect()
    assert [tuple(row) for row in got] == [(1, "x.net", "/", None, "block")][:len(pages)]


def test_deep_nesting(spark):
    rules = [("h.net", "/" + "a/" * k, "block" if k % 2 else "allow") for k in range(200)]
    pages = spark.createDataFrame([(k, "http://h.net/" + "a/" * k + "b") for k in range(250)], "page_id long, url string")
    rows = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert {row.page_id: row.rule for row in rows} == {k: "h.net/" + "a/" * min(k, 199) for k in range(250)}
