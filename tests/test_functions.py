"""Scalar functions on edge cases."""

import pytest
from pyspark.sql import functions as F

from crawlweave.functions import addresses, messages, text, urls
from crawlweave.operators import links


def column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")


def apply(spark, values, use, type_="string"):
    rows = column(spark, values, type_).select("i", use(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


MESSAGES = [
    ("0|http://h/a", (0, "http://h/a"), (0, "http://h/a")),
    ("12|http://h/a|b", (12, "http://h/a|b"), (12, "http://h/a|b")),
    ("http://h/x", (0, "http://h/x"), (0, "http://h/x")),
    ("|http://h/y", (0, "http://h/y"), (0, "|http://h/y")),
    ("x|http://h/z", (0, "http://h/z"), (0, "x|http://h/z")),
    ("3abc|http://h/q", (0, "http://h/q"), (3, "http://h/q")),
    (" 3|http://h/s", (0, "http://h/s"), (3, "http://h/s")),
    ("+3|http://h/p", (3, "http://h/p"), (3, "http://h/p")),
    ("-1|http://h/n", (-1, "http://h/n"), (-1, "http://h/n")),
    ("99999999999|http://h/o", (0, "http://h/o"), (99999999999, "http://h/o")),
    ("0x1f|u", (0, "u"), (31, "u")),
]


def test_decode(spark):
    raw = [m[0] for m in MESSAGES]
    assert [tuple(r) for r in apply(spark, raw, messages.decode_export)] == [m[1] for m in MESSAGES]
    assert [tuple(r) for r in apply(spark, raw, messages.decode_live)] == [m[2] for m in MESSAGES]


def test_encode_round_trip(spark):
    df = column(spark, ["http://h/a|b", "u"]).withColumn("m", messages.encode_message(F.col("i"), F.col("v")))
    back = df.select("i", "v", messages.decode_export(F.col("m")).alias("d")).collect()
    assert all((r["d"]["depth"], r["d"]["url"]) == (r["i"], r["v"]) for r in back)


@pytest.mark.parametrize(
    "base, href, want",
    [
        ("http://h.com/a/b?x=1", "c", "http://h.com/a/c"),
        ("http://h.com/a/b", "../c", "http://h.com/c"),
        ("http://h.com/a/b/", "./c/./d/../e", "http://h.com/a/b/c/e"),
        ("http://h.com/a/b/", "..", "http://h.com/a/"),
        ("http://h.com", "x", "http://h.com/x"),
        ("http://h.com", "../../x", "http://h.com/x"),
        ("http://h.com/a/b", "/r?q=../z", "http://h.com/r?q=../z"),
        ("https://h.com/a/b", "//o.org/p", "https://o.org/p"),
        ("http://h.com/a/b?x=1", "?y=2", "http://h.com/a/b?y=2"),
        ("http://h.com/a/b?x=1", "#t", "http://h.com/a/b?x=1#t"),
        ("http://h.com/a/b", "", "http://h.com/a/b"),
        ("http://h.com/a/b", "  c  ", "http://h.com/a/c"),
        ("http://h.com/a/b", "http://o.org/x/../y", "http://o.org/y"),
        ("http://h.com/a/b", "mailto:me@h.com", "mailto:me@h.com"),
        ("http://h.com/a/b", "javascript:void(0)", "javascript:void(0)"),
        ("not a base", "c", ""),
        ("http://h.com/a/b", "HTTP://H.com/x", "http://H.com/x"),
        ("http://h.com/a/b", "http:c", "http://h.com/a/c"),
        ("http://h.com/a/b", "http:/c", "http://h.com/c"),
        ("https://h.com/a/b", "http:c", "http:c"),
        ("http://h.com:8080/a", "b", "http://h.com:8080/b"),
    ],
)
def test_absolutise(spark, base, href, want):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(urls.absolutise(F.col("b"), F.col("h"))).first()[0] == want


def test_url_parts(spark):
    raw = ["http://H.com:8080/a%20b?q=1#f", "http://h", "not a url", "mailto:x", None]
    assert apply(spark, raw, urls.base_url) == ["http://H.com:8080", "http://h", None, None, None]
    assert apply(spark, raw, urls.path) == ["/a b", "", None, None, None]
    assert apply(spark, raw, urls.export_host) == ["H.com", "h", "", "", ""]
    assert apply(spark, ["http://h/p+q?a=%2B+1", "http://h/p?"], urls.export_path) == ["/p+q?a=++1", "/p"]


def test_live_parts(spark):
    raw = ["HTTP://User@H.com:80/", "https://h.com?x=1", "http://h/é", "nothing", "http:///x"]
    got = [tuple(r) for r in apply(spark, raw, urls.live_parts)]
    assert got == [
        ("http", "h.com", ""), ("https", "h.com", "/?x=1"), ("http", "h", "/%C3%A9"), ("", "nothing", ""), ("", "http:///x", ""),
    ]


def test_seed_rules(spark):
    raw = [" example.com \n", "http://a", "https://a", "  ", None, "HTTP://a", "a" * 2048, "a" * 2049]
    assert apply(spark, raw, urls.normalise_seed)[:6] == [
        "https://example.com", "http://a", "https://a", None, None, "https://HTTP://a",
    ]
    assert apply(spark, raw, urls.seed_too_long) == [False] * 7 + [True]


def test_private_addresses(spark):
    private = [
        "127.0.0.1", "10.0.0.1", "172.16.0.1", "172.31.255.255", "192.168.1.1", "169.254.169.254", "0.0.0.0",
        "::1", "::", "fe80::1", "fec0::1", "0:0:0:0:0:0:0:1", "::ffff:10.0.0.1", "[::1]",
    ]
    public = ["8.8.8.8", "172.15.0.1", "172.32.0.1", "192.169.0.1", "11.0.0.1", "2001:db8::1", "fd00::1"]
    assert apply(spark, private, addresses.is_private) == [True] * len(private)
    assert apply(spark, public, addresses.is_private) == [False] * len(public)
    assert apply(spark, ["host.example", None], addresses.is_private) == [None, None]


def test_escapes(spark):
    raw = ["https://a/?x=1&y='2'", " HTTP://a", "javascript:alert(1)", "JavaScript:x", "data:text/html,x", None, "ftp://a"]
    assert apply(spark, raw, text.safe_href) == ["https://a/?x=1&amp;y=&#x27;2&#x27;", " HTTP://a", "#", "#", "#", "#", "#"]
    assert apply(spark, raw, text.safe_href_live)[:2] == ["https://a/?x=1&amp;y='2'", "#"]
    assert apply(spark, ["a", "a,b", 'a"b', "a\nb", "a\rb", None, ""], text.escape_csv) == [
        "a", '"a,b"', '"a""b"', '"a\nb"', '"a\rb"', "", "",
    ]


def test_display(spark):
    assert apply(spark, [0, 1, 2, 3], text.depth_color, "int") == [
        "hsl(0,65%,58%)", "hsl(138,65%,58%)", "hsl(275,65%,58%)", "hsl(53,65%,58%)",
    ]
    assert apply(spark, [1, 999, 1000], text.ordinal_label, "int") == ["001", "999", "1000"]
    df = spark.createDataFrame([(0, 0, 5), (1000, 3_662_999, 0), (1000, 0, 360_001_000)], "s bigint, e bigint, n bigint")
    got = df.select(text.format_duration(F.col("s"), F.col("e"), F.col("n")).alias("d")).collect()
    assert [r["d"] for r in got] == ["--:--:--", "01:01:01", "100:00:00"]


def test_trim_strips_controls(spark):
    assert apply(spark, ["\t\x01 a b \r\n", " a"], text.trim_controls) == ["a b", " a"]


def test_addresses_in_other_forms(spark):
    cases = {
        "::ffff:7f00:1": True, "0:0:0:0:0:ffff:10.0.0.1": True, "::ffff:8.8.8.8": False, "999.1.1.1": None, "::1": True, "::": True,
        "fe80::1": True, "2001:db8::1": False, "[::1]": True, "1:2:3": None, "127.0.0.1": True, "::ffff:999.1.1.1": None, "0:0:0:0:0:0:0:1": True,
    }
    df = spark.createDataFrame([(a,) for a in cases], "ip string").withColumn("p", addresses.is_private(F.col("ip")))
    assert {r["ip"]: r["p"] for r in df.collect()} == cases


def test_character_references(spark):
    cases = {
        "a&#128512;b": "a\U0001f600b", "&#99999;": chr(99999), "&#x2F;": "/", "&eacute;": "é", "&#38;lt;": "&lt;", "&amp;amp;": "&amp;",
        "&#0;": "\ufffd", "&#xD800;": "\ufffd", "&unknown;": "&unknown;", "x&y": "x&y", "&#;": "&#;", "&apos;": "'", "&#99999999999999999999;": "\ufffd",
    }
    df = spark.createDataFrame([(a,) for a in cases], "t string").withColumn("d", links._decode_entities(F.col("t")))
    assert {r["t"]: r["d"] for r in df.collect()} == cases
