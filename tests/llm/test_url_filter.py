import random

from ticklake.llm.url_filter import LAST, RULES, url_filter


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
        host, _, path = rest.partition("/")
        path = rest[len(host):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h), len(p), h + p, v) for v, h, p in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def run(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "x", 3) for i, u in enumerate(urls)], "page_id long, url string, host string, key int")
    got = url_filter(df, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], rules), urls[r.page_id]


URLS = ["http://www.Example.com/en/1", "https://example.com/en/", "http://example.com", "http://example.com?x=/en/", None, "",
        "no scheme.com/", "://", "http:///path", "http://net/es/1#a", "http://a.net/fr/?q", "http://xnet/es/", "http://b.a.net/es",
        "ftp://WWW.EXAMPLE.COM/en/a/b#c?d", "http://com/", "http://a..com/x", "http://com./", "http://example.com/en/" + "x" * 20_000,
        "http://x.com/é" + LAST, "http://x://y.com/en/", "http://example.com/EN/"]


def test_contract_rules(spark):
    run(spark, URLS + URLS[:3] * 200, list(RULES))


def test_marks_of_the_keys_in_hosts_and_paths(spark):
    urls = ["http://com,example/en/x", "http://com|example/en/", "http://a,b.example.com/en/", "http://example.com|/en/", "http://net,x/es/",
            "http://x.com/" + LAST, "http://x.com/\U0010fffe", "http://x.com/\U0010fffe0", "http://x.com/\U0010fffea" + LAST, "http://" + LAST + ".com/"]
    rules = [*RULES, ("block", "x.com", "/\U0010fffe"), ("block", "x.com", "/" + LAST), ("block", "x.com", "/\U0010fffe0"), ("block", LAST + ".com", "/")]
    run(spark, urls, rules)


def test_nested_rules_at_random(spark):
    rnd = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "org", "a.org"]
    paths = ["/", "", "/x", "/x/", "/x/y", "/x/y/z", "/y"]
    rules = sorted({(h, p): (rnd.choice(["allow", "block"]), h, p) for h in hosts for p in paths if rnd.random() < 0.5}.values())
    urls = [f"http://{rnd.choice(['', 'www.', 'c.', 'b.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'x', '/y', 'z?x', '#'])}"
            for _ in range(400)]
    run(spark, urls, rules)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    assert url_filter(pages.limit(0), rules).count() == 0
    assert [(r.rule, r.verdict) for r in url_filter(pages, rules.limit(0)).collect()] == [(None, "allow")]
