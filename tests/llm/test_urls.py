import random

from ledgerwright.llm import urls

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("b.c", "block"), (None, "block")]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, after = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = after[: next((i for i, c in enumerate(after) if c in "?#"), len(after))]
    best = None
    for rule, action in rules:
        if rule is None:
            continue
        h, _, p = rule.partition("/")
        p = rule[len(h) :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or (len(rule), len(h), rule) > (len(best[0]), len(best[0].split("/")[0]), best[0])):
            best = rule, action
    return host, path, best and best[0], best[1] if best else default


def test_verdicts_match_brute_force(spark):
    r = random.Random(3)
    part = lambda *x: r.choice(x)
    some = [None, "", "no scheme", "x://", "http://ORG/", "http://a.org", "http://a.org?x/", "http://xorg/", "a://b.c:80/", "a://d.b.c#/q"]
    some += [part("http", "HTTPS") + "://" + part("", "www.", "A.b.") + part("Example", "x") + "." + part("org", "com", "net", "b.c") + part("", "/") + part("en/", "es/", "fr/", "de/", "") + part("1", "17", "") + part("", "?a=/es/", "#t", "/") for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(some)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "rule string, action string")
    out = urls.filter_urls(pages, rules).collect()
    assert len(out) == len(some)
    for row in out:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == brute(row["url"], RULES), row["url"]


def test_filter_passes_every_listed_key_and_few_others(spark):
    keys = spark.range(2000).selectExpr("concat('h', id) AS key")
    bloom = urls.BlockedBloom(keys, 2000)
    assert bloom.table.count() <= bloom.blocks
    assert bloom.passing(keys).count() == 2000
    assert bloom.passing(spark.range(5000).selectExpr("concat('other', id) AS key")).count() < 150


def test_empty_list_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "rule string, action string")
    assert [(r["rule"], r["verdict"]) for r in urls.filter_urls(pages, none).collect()] == [(None, "allow")] * 2
    assert urls.filter_urls(pages.where("false"), spark.createDataFrame(RULES, "rule string, action string")).count() == 0


def test_many_rules_of_many_shapes(spark):
    """100,000 path rules, many of each host, of every length: nothing grows with their shapes but the list."""
    r = random.Random(8)
    letters = "abcdefgh"
    some = {f"h{r.randrange(300)}.org/" + "".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(100_000)}
    rules = [(x, r.choice(("allow", "block"))) for x in sorted(some)]
    by_host = {}
    for rule, action in rules:
        by_host.setdefault(rule.partition("/")[0], []).append((rule, action))
    urls_ = [f"https://www.{x}" + r.choice(("", "/more", "?q")) for x in r.sample(sorted(some), 1500)]
    urls_ += [f"http://h{r.randrange(300)}.org/" + "".join(r.choice(letters) for _ in range(3)) for _ in range(1500)]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    out = urls.filter_urls(pages, spark.createDataFrame(rules, "rule string, action string")).collect()
    assert len(out) == len(urls_)
    for row in out:
        host = row["url"].partition("://")[2].partition("/")[0].removeprefix("www.")
        assert (row["rule"], row["verdict"]) == brute(row["url"], by_host.get(host, []))[2:], row["url"]


def test_columns_of_any_name(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/x", "mine", "k", 3, "m")], "page_id long, url string, action string, key string, block int, url_md5 string")
    row = urls.filter_urls(pages, spark.createDataFrame(RULES, "rule string, action string")).first()
    assert (row["action"], row["key"], row["block"], row["url_md5"], row["verdict"]) == ("mine", "k", 3, "m", "block")


def test_a_filter_that_is_dealt_out(spark, monkeypatch):
    from ledgerwright.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame([(1, "http://a.com/de/x")], "page_id long, url string")
    assert urls.filter_urls(pages, spark.createDataFrame(RULES, "rule string, action string")).first()["verdict"] == "block"
