import pytest

from crawlweave.operators import fetches, screening


@pytest.mark.parametrize(
    "statuses, want",
    [
        ([503, 200], ("processed", 200, 2)),
        ([503, 503, 503], ("failed", None, 3)),
        ([404, 200], ("failed", 404, 1)),
        ([None, 304, 200], ("processed", 200, 3)),
        ([500, 500, 500, 200], ("failed", None, 3)),
        ([500], ("failed", None, 1)),
        ([204], ("processed", 204, 1)),
    ],
)
def test_outcome(spark, statuses, want):
    rows = [("u", i, s) for i, s in enumerate(statuses, 1)]
    got = fetches.fetch_outcome(spark.createDataFrame(rows, "url string, attempt int, status int")).first()
    assert (got["outcome"], got["status"], got["attempts_used"]) == want


def ips(spark):
    return spark.createDataFrame(
        [("pub", "8.8.8.8"), ("priv", "10.0.0.1"), ("mixed", "8.8.4.4"), ("mixed", "127.0.0.1"), ("none", None)], "host string, ip string"
    )


def test_screen(spark):
    urls = {
        "http://pub/": False, "http://PUB:8080/x": False, "http://priv/": True, "http://mixed/": True, "http://none/": True,
        "http://unknown/": True, "not-a-url": True, "http://": True, "http://127.0.0.1/": True, "http://93.184.216.34/": False,
        "http://[::1]/": True, "http://[2001:db8::1]/": False,
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"]: r["blocked"] for r in screening.screen(df, ips(spark)).collect()} == urls


def test_seed_admission_reasons(spark):
    df = spark.createDataFrame([(" pub/x ",), ("priv",), ("  ",), (None,), ("p" * 2049,)], "raw string")
    got = {(r["url"], r["reason"]) for r in screening.admit_seeds(df, ips(spark)).collect()}
    assert got == {("https://pub/x", None), ("https://priv", "blocked"), (None, "blank"), (None, "too long")}


def test_redirects(spark):
    chain = [(f"http://pub/{i}", f"/{i + 1}" if i % 2 else f" http://pub/{i + 1} ") for i in range(8)]
    odd = [
        ("http://pub/nowhere", None), ("http://pub/blank", "  "), ("http://pub/in", "http://priv/"), ("http://pub/loop", "/loop"),
        ("http://pub/to-in", "/in"), ("http://pub/up/down", "../side"),
    ]
    redirects = spark.createDataFrame(chain + odd, "src string, location string")
    pages = spark.createDataFrame([(u,) for u, _ in chain + odd] + [("http://pub/8",)], "url string")
    got = {
        r["url"].removeprefix("http://pub/"): (r["final_url"], r["hops"], r["error"])
        for r in fetches.resolve_redirects(pages, redirects, ips(spark)).collect()
    }
    end = "http://pub/8"
    assert got == {
        "8": (end, 0, None), "7": (end, 1, None), "6": (end, 2, None), "5": (end, 3, None), "4": (end, 4, None), "3": (end, 5, None),
        "2": (None, 6, "too many redirects"), "1": (None, 6, "too many redirects"), "0": (None, 6, "too many redirects"),
        "nowhere": (None, 1, "missing location"), "blank": (None, 1, "missing location"), "in": (None, 1, "blocked target"),
        "loop": (None, 6, "too many redirects"), "to-in": (None, 2, "blocked target"), "up/down": ("http://pub/side", 1, None),
    }
