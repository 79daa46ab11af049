import random
import re

from pyspark.sql import functions as F

from registrylake.llm import url_rules as U


def brute(url, sites, patterns):
    """host, path, site rule and verdict by trying every rule."""
    host = path = ""
    if url and "://" in url:
        tail = re.split("[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, rest = tail.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + rest
    fits = []
    for verdict, rule in sites:
        rule_host, slash, rest = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            fits.append((-len(rule), rule, verdict))
    if fits and host + path:
        return host, path, min(fits)[1], min(fits)[2]
    hits = [v for v, p in patterns if host + path and re.search(U.pattern_regex(p), host + path)]
    return host, path, None, "block" if "block" in hits else "allow"


def test_equals_brute_force(spark):
    rng = random.Random(6)
    hosts = ["example.com", "www.example.com", "EXAMPLE.com", "a.net", "x.example.net", "casino-win.org", "m.free-bets.org",
             "notexample.com", "org", "poker.net:80", "my-casinos.org", "com", "é.com"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/x?y=/en/", "/EN/", "/casino/1", "/casino-history/", "#top", "?q", "/a//en/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "no scheme", "http:/x.com/", "a://b://com/en/", "http://", "http://a\nb.com/x\ny"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, urls[0]), (0, urls[0])]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, rule int")
    judged = U.judge_urls(pages, U.rule_table(spark))
    got = sorted(map(tuple, judged.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got == sorted([(i, *brute(u, U.SITE_RULES, U.PATTERNS)) for i, u in rows], key=repr)
    assert U.judge_urls(pages.limit(0), U.rule_table(spark)).collect() == []


def test_tokens_are_whole_in_every_url_that_fits():
    assert U.literal_tokens("example.com/en/", False) == ["example", "com", "en"]
    assert U.literal_tokens("example.com/en", False) == ["example", "com"]
    assert U.literal_tokens("^free-bets^", True) == ["free", "bets"]
    assert U.literal_tokens("free*bets", True) == [""]
    assert U.literal_tokens("/ad*/track/", True) == ["track"]


def test_rules_without_tokens_and_many_rules(spark):
    patterns = [(U.BLOCK, "ads*"), *((U.BLOCK, f"^word{i}^") for i in range(300))]
    pages = spark.createDataFrame([(1, "http://a.b/xads1"), (2, "http://word7.de/"), (3, "http://word.de/")], "page_id long, url string")
    judged = U.judge_urls(pages, U.rule_table(spark, [], patterns))
    assert {r["page_id"]: (r["verdict"], r["pattern"]) for r in judged.collect()} == {
        1: ("block", "ads*"), 2: ("block", "^word7^"), 3: ("allow", None)
    }
    none = spark.createDataFrame([], "rule string, verdict string, regex string, site boolean, tokens array<string>")
    assert {r["verdict"] for r in U.judge_urls(pages, none).collect()} == {"allow"}


def test_a_hot_place_is_split_and_names_clash(spark):
    rows = [(i, "http://poker.net/de/8" if i % 3 else None) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("__site", "place", "page", "token", "site", "regex", "by_site", "n"):
        pages = pages.withColumn(name, F.lit("own"))
    judged = U.judge_urls(pages, U.rule_table(spark))
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict", "pattern"]
    got = {(r["page_id"] % 3 > 0, r["verdict"], r["__site"], r["n"]) for r in judged.collect()}
    assert got == {(True, "block", "own", "own"), (False, "allow", "own", "own")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = U.judge_urls(pages, U.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(place" in plan and "__shuffle_key" in plan


def test_many_listed_patterns(spark):
    patterns = U.listed_patterns()
    assert len(patterns) == 4000
    rows = [(1, "http://a.org/de/8"), (2, "http://a.org/de/9"), (3, "http://a.org/es/13.html?x"), (4, "http://a.org/de/81")]
    judged = U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), U.rule_table(spark, patterns=patterns))
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow"}
