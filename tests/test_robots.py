import pytest

from crawlweave.operators import robots


def rules_of(spark, body, status=200, agent="crawlbot"):
    df = spark.createDataFrame([("http://h", status, body)], "base_url string, status int, body string")
    return robots.parse_robots(df, agent).first()


def allowed(spark, body, *addresses):
    rules = robots.parse_robots(
        spark.createDataFrame([("http://h", 200, body)], "base_url string, status int, body string"), "crawlbot"
    )
    df = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, url string")
    return [r["allowed"] for r in robots.match_robots(df, rules).orderBy("i").collect()]


def test_sections(spark):
    body = (
        "Disallow: /orphan\r\n# note\r\n USER-AGENT : no\nUser-agent: Other\nDisallow: /other\r"
        "user-agent:crawlBOT\nDisallow: /a # kept\nAllow: /a/b\nDisallow:\nDisallow: /a # kept\n"
        "User-agent: first\nUser-agent: *\n  disallow: /long/path\nDisallow: /x\nCrawl-delay: 2.5\nCrawl-delay: soon\n"
    )
    got = rules_of(spark, body)
    # only the latest agent line counts, and "USER-AGENT :" is not one
    assert got["disallows"] == ["/long/path", "/a # kept", "/x"]
    assert got["allows"] == ["/a/b"]
    assert got["crawl_delay_ms"] == 2500


def test_not_served_means_no_rules(spark):
    got = rules_of(spark, "User-agent: *\nDisallow: /", status=404)
    assert (got["disallows"], got["allows"], got["crawl_delay_ms"]) == ([], [], 0)


@pytest.mark.parametrize(
    "text, want",
    [("86400", 60_000), ("5", 5_000), ("60", 60_000), ("0", 0), ("-3", -3_000), ("Infinity", 60_000), ("NaN", 0),
     ("1e1", 10_000), ("0.0019", 1), ("2f", 2_000), ("ten", 0), ("", 0)],
)
def test_crawl_delay(spark, text, want):
    assert rules_of(spark, f"User-agent: *\nCrawl-delay: {text}")["crawl_delay_ms"] == want


def test_last_valid_delay_wins(spark):
    body = "User-agent: *\nCrawl-delay: 1\nUser-agent: crawlbot\nCrawl-delay: 3\nCrawl-delay: bad"
    assert rules_of(spark, body)["crawl_delay_ms"] == 3000


@pytest.mark.parametrize(
    "rules, address, want",
    [
        ("Disallow: /foo\nAllow: /foobar", "http://h/foobar/x", True),
        ("Allow: /foo\nDisallow: /foobar", "http://h/foobar/x", False),
        ("Allow: /foo\nDisallow: /foo", "http://h/foo", True),
        ("Disallow: /foo", "http://h/foo", False),
        ("Disallow: /foo", "http://h/bar", True),
        ("Disallow: /", "http://h", True),
        ("Disallow: /", "http://h/", False),
        ("Disallow: /a b", "http://h/a%20b", False),
        ("Disallow: /q", "http://h/?x=/q", True),
        ("Disallow: /*.gif$", "http://h/x.gif", True),
        ("Disallow: /x", "not a url", False),
        ("Disallow: /x", "mailto:a@h", False),
        ("Disallow: /x", "http://h:81/x", True),
    ],
)
def test_decision(spark, rules, address, want):
    assert allowed(spark, f"User-agent: *\n{rules}", address) == [want]


def test_refresh_after_thirty_minutes(spark):
    minute = 60_000
    times = [0, 10, 29, 30, 31, 59, 60, 200]
    df = spark.createDataFrame([("http://h", i, t * minute) for i, t in enumerate(times)], "base_url string, seq bigint, t_ms bigint")
    got = robots.refresh_plan(df, "t_ms", "seq").orderBy("seq").collect()
    assert [r["refetched"] for r in got] == [True, False, False, True, False, False, True, True]
    assert [r["rules_fetched_ms"] // minute for r in got] == [0, 0, 0, 30, 30, 30, 60, 200]
