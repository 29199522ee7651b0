from affinity.llm import url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))] if rest.startswith("/") else ""
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path


def rule(host, path):
    fits = []
    for r, _ in url_filter.RULES:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(r)
    return min(fits, key=lambda r: (-len(r), r), default=None)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/x", "http://example.net/en", "http://example.net/en/", "x://net", "x://net/",
    "http://bet/", "http://a.org/fr/?q", "http://org/fr/#x", "http://forg/fr/", "https://example.com/de/a://b/c", "http://É.com/a b", "http://h?x/y#z",
    "http://casino.example.org/en/1", "http://a\nb.net/c\nd?e", "http://example.com/de/", "http://example.com/de/",
]


def test_parts_and_rules_equal_brute_force(spark, sf):
    urls = URLS + [r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("url").collect()]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").selectExpr("*", "'x' as host", "1 as rule")
    got = {r["page_id"]: r for r in url_filter.judge(pages, url_filter.labelled_urls(spark)).collect()}
    verdicts = dict(url_filter.RULES)
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = parts(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule(host, path)), url
        assert got[i]["verdict"] in ("allow", "block")
        if got[i]["rule"]:
            assert got[i]["verdict"] == verdicts[got[i]["rule"]]


def test_model_tells_unwanted_hosts(spark):
    unwanted = ["https://best-casino.example.org/en/7", "http://www.free-bets.example.org/de/1.html", "https://m.cheap-pills.example.org/en/2"]
    wanted = ["https://city-library.example.org/en/7", "http://www.ththerer.example.org/de/1.html", "https://m.eauelle.example.org/en/2", "https://blog.travel.example.org/es/3"]
    pages = spark.createDataFrame(list(enumerate(unwanted + wanted)), "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, url_filter.labelled_urls(spark)).collect()}
    assert [got[i] for i in range(7)] == ["block"] * 3 + ["allow"] * 4


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(pages, url_filter.labelled_urls(spark)).count() == 0
