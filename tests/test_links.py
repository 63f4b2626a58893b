from crawlweave.operators import links


def extract(spark, url, html):
    df = spark.createDataFrame([(url, html)], "url string, html string")
    return [(r["pos"], r["href"], r["link"]) for r in links.extract_links(df).orderBy("pos").collect()]


def test_markup_variants(spark):
    html = """<html><!-- <a href="/no">x</a> --><script>var s='<a href="/no2">';</script>
    <A HREF='/one'>1</A><a class="a>b" data-href="/no3" href="/two?a=1&amp;b=2">2</a>
    <a href=/three>3</a><a name="x">none</a><a title=" href=/no4 " href = "four" >4</a><abbr href="/no5">x</abbr>
    <a href>5</a><a
       href="/six&#233;">6</a><a href="/a'b">7</a></html>"""
    assert extract(spark, "http://h/d/p", html) == [
        (0, "/one", "http://h/one"),
        (1, "/two?a=1&b=2", "http://h/two?a=1&b=2"),
        (2, "/three", "http://h/three"),
        (3, "four", "http://h/d/four"),
        (4, "", "http://h/d/p"),
        (5, "/sixé", "http://h/sixé"),
        (6, "/a'b", "http://h/a'b"),
    ]


def test_base_element(spark):
    html = '<head><base href="/other/"></head><a href="x">1</a><a href="http://o/y">2</a>'
    assert [link for _, _, link in extract(spark, "http://h/d/p", html)] == ["http://h/other/x", "http://o/y"]


def test_unclosed_comment_hides_the_rest(spark):
    assert extract(spark, "http://h/", '<a href="/a">1</a><!-- <a href="/b">') == [(0, "/a", "http://h/a")]


def test_missing_page_gives_nothing(spark):
    df = spark.createDataFrame([(None, "<a href='/x'>"), ("http://h", None), ("http://h", "")], "url string, html string")
    assert links.extract_links(df).count() == 0


def test_long_documents_are_whole(spark):
    n = 20_000
    html = "<p title='" + "x" * 50_000 + "'>" + "".join(f'<a href="/{i}">t</a>' for i in range(n))
    assert len(extract(spark, "http://h/", html)) == n


def test_follow_filter(spark):
    rows = [
        ("http://H.com/p", link)
        for link in (
            "http://h.com/a", "https://h.com:8443/b", "http://h.com/c#top", "", "HTTP://h.com/d", "ftp://h.com/e",
            "http://sub.h.com/f", "mailto:x@h.com", "http://h.com/with blank", "http://h.com/ünï",
        )
    ]
    df = spark.createDataFrame(rows, "url string, link string")
    kept = [r["link"] for r in links.follow_filter(df).collect()]
    assert kept == ["http://h.com/a", "https://h.com:8443/b", "http://h.com/ünï"]
