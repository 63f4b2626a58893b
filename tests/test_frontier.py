import pytest
from pyspark.sql import functions as F

from crawlweave.operators import frontier, links, robots
from crawlweave.session import new_path
from crawlweave.sources.tables import stored_pages


def seeds_of(spark, *urls):
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, n bigint")
    return frontier.seed_frontier(df, "url", None, "n")


def links_of(spark, graph):
    rows = [(s, d, i) for s, ds in graph.items() for i, d in enumerate(ds)]
    return spark.createDataFrame(rows or [("", "", 0)], "src string, dst string, pos int")


def rules_of(spark, *paths):
    body = "User-agent: *\n" + "\n".join(f"Disallow: {p}" for p in paths)
    df = spark.createDataFrame([("http://h", 200, body)], "base_url string, status int, body string")
    return robots.parse_robots(df, "crawlbot")


def log_of(result):
    return [(r["url"], r["depth"], r["state"]) for r in result.log.orderBy("seq").collect()]


GRAPH = {"http://h/": ["http://h/a", "http://h/b"], "http://h/a": ["http://h/b", "http://h/c", "http://h/"], "http://h/c": ["http://h/d", "http://h/d"]}


def test_first_in_first_out_and_shortest_depth(spark):
    result = frontier.crawl(seeds_of(spark, "http://h/"), links_of(spark, GRAPH), ordered=True)
    assert log_of(result) == [(f"http://h/{p}", d, "processed") for p, d in (("", 0), ("a", 1), ("b", 1), ("c", 2), ("d", 3))]
    got = {(r["depth"], r["candidates"], r["duplicates"]) for r in frontier.duplicate_attempts(result).collect()}
    assert got == {(1, 2, 0), (2, 3, 2), (3, 2, 1)}


def test_seed_rules(spark):
    got = seeds_of(spark, "http://h/", "  ", None, "http://h/", "http://h")
    assert sorted(r["url"] for r in got.collect()) == ["http://h", "http://h/"]


@pytest.mark.parametrize("limit, want", [(0, 1), (1, 3), (2, 4), (None, 5)])
def test_depth_limit(spark, limit, want):
    result = frontier.crawl(seeds_of(spark, "http://h/"), links_of(spark, GRAPH), max_depth=limit)
    assert result.log.count() == want


def test_cut_links_are_not_duplicates(spark):
    result = frontier.crawl(seeds_of(spark, "http://h/"), links_of(spark, GRAPH), max_depth=1)
    assert [(r["depth"], r["duplicates"]) for r in frontier.duplicate_attempts(result).collect()] == [(1, 0)]


def test_blocked_pages_keep_the_budget(spark):
    urls = ["http://h/no/1", "http://h/1", "http://h/no/2", "http://h/2", "http://h/3", "http://h/4", "http://h/5"]
    result = frontier.crawl(
        seeds_of(spark, *urls), links_of(spark, {}), max_pages=4, rules=rules_of(spark, "/no")
    )
    assert [s for _, _, s in log_of(result)] == [
        "robots_blocked", "processed", "robots_blocked", "processed", "processed", "processed", "queued",
    ]


def test_budget_is_never_exceeded(spark):
    graph = {"http://h/0": [f"http://h/{i}" for i in range(1, 21)]}
    result = frontier.crawl(seeds_of(spark, "http://h/0"), links_of(spark, graph), max_pages=5)
    states = [s for _, _, s in log_of(result)]
    assert states.count("processed") == 5 and states.count("queued") == 16


def test_failures_use_the_budget_and_do_not_expand(spark):
    outcome = {"http://h/a": "failed", "http://h/b": "handler_error"}
    known = spark.createDataFrame(list(outcome.items()), "url string, outcome string")
    result = frontier.crawl(
        seeds_of(spark, "http://h/"), links_of(spark, GRAPH), max_pages=3, fetch=lambda rows: rows.join(known, "url", "left")
    )
    assert log_of(result) == [("http://h/", 0, "processed"), ("http://h/a", 1, "failed"), ("http://h/b", 1, "handler_error")]


def test_small_site_ends_early(spark):
    result = frontier.crawl(seeds_of(spark, "http://h/"), links_of(spark, GRAPH), max_pages=1000)
    assert result.log.count() == 5


def test_no_seed_no_crawl(spark):
    assert frontier.crawl(seeds_of(spark, " "), links_of(spark, GRAPH), ordered=True).log.count() == 0


def test_crawls_do_not_share_seen_sets_or_budgets(spark):
    df = spark.createDataFrame([("http://h/", 1, 1), ("http://h/", 2, 2)], "url string, crawl bigint, n bigint")
    result = frontier.crawl(frontier.seed_frontier(df, "url", "crawl", "n"), links_of(spark, GRAPH), max_pages=4)
    got = result.log.groupBy("crawl_id", "state").count().collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(1, "processed", 4), (2, "processed", 4), (1, "queued", 1), (2, "queued", 1)}


def test_crawl_over_stored_pages(spark):
    pages = spark.createDataFrame(
        [("http://h/", '<a href="a">1</a><a href="http://other/">2</a><a href="/gone">3</a>'), ("http://h/a", '<a href="/">back</a>')],
        "url string, html string",
    )
    result = frontier.crawl(seeds_of(spark, "http://h/"), frontier.expand_pages(pages), fetch=stored_pages(pages), ordered=True)
    assert log_of(result) == [("http://h/", 0, "processed"), ("http://h/a", 1, "processed"), ("http://h/gone", 1, "failed")]


def test_bucketed_links_are_not_shuffled(spark):
    table = links.bucketed_links(links_of(spark, GRAPH), "crawl_links_test", new_path(spark, "links"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        handled = spark.createDataFrame([(0, "http://h/", 0, 1)], "crawl_id bigint, url string, depth int, seq bigint")
        plan = frontier.expand_with(table)(handled)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table crawl_links_test")


def test_seen_set_is_not_shuffled(spark):
    """Only the candidates move: the levels so far lie in the buckets that the candidates are dealt to."""
    levels = frontier._Levels(spark)
    rows = spark.range(500).selectExpr("id % 3 as crawl_id", "concat('http://h/', id) as url", "0 as depth", "id as seq", "'processed' as state", "1L as offered")
    levels.add(rows)
    levels.add(rows.selectExpr("crawl_id", "concat(url, 'x') as url", "1 as depth", "seq", "state", "offered"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rows.selectExpr("crawl_id", "concat(url, if(seq % 2 = 0, 'x', 'y')) as url", "depth", "seq as parent_seq", "0L as pos")
        fresh = frontier.next_frontier(found, levels.seen())
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
        assert sorted(r.url for r in fresh.collect()) == sorted(f"http://h/{i}y" for i in range(1, 500, 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        levels.forget()
    assert not spark.catalog.tableExists(levels.name) and levels.files().count() == 1000


def test_refused_seeds_are_counted(spark):
    result = frontier.crawl(seeds_of(spark, "http://h/", "http://h/", "http://h/b"), links_of(spark, GRAPH))
    got = {(r["depth"], r["candidates"], r["accepted"], r["duplicates"]) for r in frontier.duplicate_attempts(result).collect()}
    assert got == {(0, 3, 2, 1), (1, 2, 1, 1), (2, 3, 1, 2), (3, 2, 1, 1)}


def test_bad_and_screened_addresses(spark):
    """A bad address is no page of the budget, with or without rules; a blocked one fails without a fetch."""
    rows = [(1, "http://h/ok"), (2, "http://h/a b|c"), (3, "http://private/x"), (4, "http://h/last")]
    seeds = frontier.seed_frontier(spark.createDataFrame(rows, "n int, url string"), order="n")
    none = spark.createDataFrame([], "src string, dst string, pos int")
    block = lambda level: level.withColumn("blocked", F.col("url").contains("private"))
    log = frontier.crawl(seeds, none, max_pages=3, screen=block).log.collect()
    assert {r["url"]: r["state"] for r in log} == {
        "http://h/ok": "processed", "http://h/a b|c": "bad_url", "http://private/x": "failed", "http://h/last": "processed",
    }
