import random

from ledgerloom.llm import urls

RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/e"),
    urls.Rule("allow", "net", "/en/a"),
    urls.Rule("block", "net", "/en/a"),
    urls.Rule("block", "b.net", ""),
]


def brute(host, path):
    fits = [
        (r.host.count(".") + 1, len(r.path), r.verdict, r.host + r.path)
        for r in RULES
        if ("." + host).endswith("." + r.host) and path.startswith(r.path)
    ]
    return (max(fits)[2], max(fits)[3]) if fits else None


def addresses():
    pick = random.Random(5)
    labels, parts = ["www", "example", "com", "net", "b", ""], ["en", "e", "a", "", "english", "ab"]
    for _ in range(300):
        host = ".".join(pick.choice(labels) for _ in range(pick.randint(1, 4)))
        path = "".join("/" + pick.choice(parts) for _ in range(pick.randint(0, 3)))
        yield host, path


def test_trie_finds_the_longest_rule():
    trie = urls.build_trie(RULES)
    for host, path in addresses():
        assert urls.longest_match(trie, host, path) == brute(host, path), (host, path)


def test_table_of_rules_gives_the_same(spark):
    rows = [(n, f"http://{h}{p}?q#f", "clash") for n, (h, p) in enumerate(addresses())]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    ways = [urls.judge_urls(pages, RULES), urls.judge_urls(pages, rules), urls.judge_urls(pages, RULES, rule_bytes=0)]
    results = [sorted(map(tuple, w.collect())) for w in ways]
    assert results[0] == results[1] == results[2] and len(results[0]) == 300
    for number, host, path, rule, verdict in results[0]:
        assert (verdict, rule) == (brute(host, path) or ("allow", None))


def test_odd_addresses(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "no scheme.com/x"), (4, "HTTP://WWW.Example.COM/EN/"), (5, "x://com")]
    rows += [(6, "http://a.com/" + "y/" * 5000), (None, "://com/#://net/e"), (7, "a://net?/e")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r for r in urls.judge_urls(pages, RULES, default="block").collect()}
    assert urls.judge_urls(pages, RULES).count() == len(rows)
    assert [tuple(found[1])[1:], tuple(found[2])[1:]] == [("", "", None, "block")] * 2 == [tuple(found[3])[1:]] * 2
    assert tuple(found[4])[1:] == ("www.example.com", "/EN/", "com/", "allow")
    assert tuple(found[5])[1:] == ("com", "", None, "block")
    assert found[6]["rule"] == "com/" and tuple(found[None])[1:] == ("com", "/", "com/", "allow")
    assert tuple(found[7])[1:] == ("net", "", None, "block")
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0


def test_repeated_and_null_keys_are_judged_by_row(spark):
    rows = [(1, "http://a.com/x"), (1, "http://net/e"), (None, "http://b.net/"), (None, "http://com/"), (1, "http://a.com/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    ways = [urls.judge_urls(pages, RULES), urls.judge_urls(pages, RULES, rule_bytes=0)]
    one, two = (sorted((repr(r) for r in w.collect())) for w in ways)
    assert one == two and len(one) == len(rows)
    assert sum("'block'" in r for r in one) == 2
