import random

import pytest

from shapeloom.llm.url_filter import filter_pages


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([k for k in map(path.find, "?#") if k >= 0], default=len(path))]
    best = max(((len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules
                if h and host and (host == h or host.endswith("." + h)) and path.startswith(p or "")), default=None)
    return host, path, best and best[2], best[3] if best else default


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = filter_pages(pages, table).collect()
    assert len(rows) == len(urls)
    return {r.page_id: (r._host, r._path, r._rule, r._verdict) for r in rows}


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_edges(spark):
    urls = [None, "", "no scheme.com/", "http://", "https://COM/", "http://com", "http://com?x=/", "http://a.com/#/en/",
            "http://example.com/en/1?q", "http://m.example.com/en/", "http://www.example.com/en/x", "http://a.www.example.com/en/x",
            "http://wwww.example.com/en/x", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/esp", "http://net/fr/://b",
            "a://b.com/c://d.net/es/", "http://.com/", "http://É.COM/É", "http://x..net/fr/", "http://example.com/en/1?q",
            "x\n://y.net\n/es/", "http://com/" + "a" * 200_000, "http://u@example.com:80/en/"]
    assert run(spark, urls, RULES) == {i: brute(u, RULES) for i, u in enumerate(urls)}
    assert run(spark, urls[:9], []) == {i: brute(u, []) for i, u in enumerate(urls[:9])}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_nested_rules(spark, seed):
    rng = random.Random(seed)
    def host():
        return ".".join(rng.choice(["a", "b", "ab", "com", ""]) for _ in range(rng.randint(1, 4)))
    def path():
        return "".join(rng.choice(["/", "a", "b", "/a"]) for _ in range(rng.randint(0, 5)))
    rules = [(host(), rng.choice([path(), None]), rng.choice(["allow", "block"])) for _ in range(120)] + [(None, "/", "block")]
    urls = [f"http://{host()}/{path()}" for _ in range(800)]
    assert run(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_empty(spark):
    assert run(spark, [], RULES) == {}


def test_columns_named_like_its_own(spark):
    from shapeloom.llm.url_filter import filter_pages
    pages = spark.createDataFrame([("http://a.com/x" + "y" * 100_000, 1, 2, 3)], "url string, _url int, _host int, _Rule int")
    rules = spark.createDataFrame([("com", "/x", "block")], "host string, path string, verdict string")
    got = filter_pages(pages, rules)
    assert got.columns == ["url", "_url", "_host", "_Rule", "__host", "_path", "__rule", "_verdict"]
    row = got.first()
    assert (row["_url"], row["_host"], row["_Rule"], row["__host"], row["__rule"], row["_verdict"]) == (1, 2, 3, "a.com", "com/x", "block")
