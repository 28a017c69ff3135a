from __future__ import annotations

import random

from millrace.llm.url_filter import judge_urls

PAGES = "page_id long, url string, host string, cell string, rule string"
RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [
        (len(h + (p or "")), len(h), v == "block", h + (p or ""), v) for h, p, v in rules
        if h and v and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def check(spark, urls, rules):
    rows = [(i, u, "h", "c", "r") for i, u in urls]
    found = judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES)).collect()
    want = sorted(((i, *brute(u, rules)) for i, u in urls), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_edge_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", None, "block"),
             (None, "/", "block"), ("", "/", "block"), ("com", "/", "block")]
    urls = [None, "", "nothing", "http://", "http://COM/x", "http://example.com/en/1", "http://www.Example.com/en/?a#b", "http://a.net",
            "http://a.net?x=/en/", "https://xexample.com/en/", "://example.com/en/x", "http://u:p@h.com:80/x", "http://a..com/", "http://É.com/"]
    check(spark, [*enumerate(urls), (None, "http://a.net/"), (3, "http://a.net/"), (3, "http://a.net/"), (3, "http://a.net/")], rules)


def test_random_urls_and_nested_rules(spark):
    draw = random.Random(3)
    hosts = [".".join(draw.choice("ab") for _ in range(draw.randint(1, 4))) for _ in range(40)]
    paths = ["/" + "".join(draw.choice("x/") for _ in range(draw.randint(0, 5))) for _ in range(40)]
    rules = list({(draw.choice(hosts), draw.choice(paths)[: draw.randint(0, 4)]): draw.choice(["allow", "block"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    check(spark, [(i, f"http://{draw.choice(hosts)}{draw.choice(paths)}") for i in range(300)], rules)


def test_empty_tables(spark):
    check(spark, [], [("com", "/", "block")])
    check(spark, [(1, "http://a.com/"), (2, None)], [])
