"""URL filters, decontamination and quality rules against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlweave.llm import decontaminate, quality_rules, url_filter
from crawlweave.llm.queries import RULES

URLS = [
    "https://www.Example.ORG/en/148.html", "http://example.org/es/1", "http://a.b.org?x=/en/1", "http://fr.com/fr/x#y", "x://de.com/de/",
    "http://notexample.org/es/", "http://example.org", "no scheme", None, "", "http://", "a://com/fr/", "http://x..com/de/1",
    "http://h.net/a?b://c.org/", "http://user@m.com:80/de/q", "http://exam\nple.com/de/\nz", "http://" + "a." * 3000 + "org/" + "p/" * 3000,
]


def judged(url, rules):
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.fixture(params=["10485760", "-1"])
def broadcasts(spark, request):
    """With Spark's own broadcasts by measured size, and without any."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_urls(spark, broadcasts):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id int, url string").withColumn("rule", F.lit("old"))
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("x.com", None, None), *RULES], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {i: judged(u, RULES) for i, u in enumerate(URLS * 2)}


def test_many_and_long_rules(spark):
    """Rules of very many lengths for one host cost only the URLs of that host; no rule is too long."""
    long_path = "/" + "p" * 5000
    rules = [("deep.org", "/" + "x" * i, "block") for i in range(1, 300)] + [("deep.org", long_path, "allow"), ("org", "", "allow"), ("a" * 3000 + ".net", "/", "block")]
    urls = [f"http://deep.org/{'x' * 150}", f"http://deep.org{long_path}/q", "http://other.org/xx", f"http://{'a' * 3000}.net/z", "http://none.com/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: judged(u, rules)[2:] for i, u in enumerate(urls)}
    assert got[0] == ("deep.org/" + "x" * 150, "block") and got[1][1] == "allow" and got[3][1] == "block"


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://a.org/",)], "url string")
    assert url_filter.judge(pages, rules, default="block").first().verdict == "block"
    assert url_filter.judge(pages.limit(0), rules).collect() == []


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(text, items):
    w, hit, ids = tokens(text), set(), set()
    for key, item in items:
        v = tokens(item)
        m = min(13, len(v))
        windows = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if v else set()
        for i in range(len(w) - m + 1):
            if windows and tuple(w[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                ids.add(key)
    return len(w), len(hit), sorted(k for k in ids if k is not None), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("bits", [1 << 24, 1 << 6])
def test_decontamination(spark, broadcasts, monkeypatch, bits):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)  # with few bits nearly everything passes to the join
    draw = random.Random(3)
    word = lambda: draw.choice(["a", "b", "cé", "D1", "e"])
    items = [(i, ", ".join(word() for _ in range(draw.choice([1, 3, 5, 12, 13, 14, 40])) )) for i in range(6)]
    items += [(90, None), (91, ""), (None, "zz yy xx ww"), (1, items[1][1]), (92, "--")]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(draw.randrange(0, 60))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, draw.choice(items)[1] or "")
        docs.append((i, "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (103, "q " * 3000 + "zz yy XX ww"), (None, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id int, text string").withColumn("items", F.lit(1)).withColumn("w", F.lit(2))
    bench = spark.createDataFrame(items, "item_id int, text string").withColumn("length", F.lit("x"))
    got = sorted(((r.doc_id or -1), r.n_words, r.n_hit, list(r.items or []), r.contaminated) for r in decontaminate.judge(df, bench).collect())
    assert got == sorted(((k or -1), *contamination(t, items)) for k, t in docs)
    assert not decontaminate.judge(df, bench.limit(0)).where("contaminated").count()
    assert decontaminate.judge(df.limit(0), bench).count() == 0


def figures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    repeated = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_statistics(spark):
    draw = random.Random(9)
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "x x x x", "é#\n\né#\n$%&|<>*", "a\u00a0b c\u0085d"]
    texts += [" ".join(draw.choice(["a", "b", "c", "dd#", "e\n"]) for _ in range(draw.randrange(200))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").withColumn("n_words", F.lit("old"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.judge(df, [(quality_rules.Condition("symbol_share", True, 0.5),)])
    got = {r.doc_id: r for r in judged.collect()}
    for i, t in enumerate(texts):
        want = figures(t)
        assert tuple(got[i][n] for n in names) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i].base_failed == failed
        assert got[i].kept == (not failed and want[2] < 0.5 * want[0])
    assert {r.doc_id for r in judged.where("kept").select("doc_id").collect()} == {i for i, r in got.items() if r.kept}


def test_rules_are_learned(spark):
    draw = random.Random(1)
    rows = [{f: draw.random() for f in quality_rules.FIGURES} for _ in range(900)]
    for r in rows:
        r["bad"] = int(r["symbol_share"] > 0.7 and r["word_length"] < 0.5)
    rules = quality_rules.cover(rows)
    wrong = sum(any(all(c.holds(r) for c in rule) for rule in rules) != bool(r["bad"]) for r in rows)
    assert rules and wrong < 15
    df = spark.createDataFrame(rows)
    kept = [r[0] for r in df.select(quality_rules.verdict(rules)).collect()]
    assert sum(k == bool(r["bad"]) for k, r in zip(kept, rows)) == wrong
    assert quality_rules.cover([r | {"bad": 0} for r in rows]) == [] == quality_rules.cover([])


def brute_first_condition(rows):
    """The single condition with the highest gain, all boundaries of all figures tried row by row."""
    bad, best = sum(r["bad"] for r in rows), (0.0, None)
    for figure in quality_rules.FIGURES:
        values = sorted({r[figure] for r in rows})
        for low, high in zip(values, values[1:]):
            for above in (False, True):
                inside = [r for r in rows if (r[figure] >= (low + high) / 2) == above]
                b = sum(r["bad"] for r in inside)
                gain = b * (math.log2(b / len(inside)) - math.log2(bad / len(rows))) if b else 0.0
                if gain > best[0] + 1e-9:
                    best = (gain, {id(r) for r in inside})
    return best


@pytest.mark.parametrize("seed", range(6))
def test_grown_condition_is_the_best(seed, monkeypatch):
    monkeypatch.setattr(quality_rules, "CONDITIONS", 1)
    draw = random.Random(seed)
    rows = [{f: draw.choice([0.0, 0.0, 0.5, draw.random()]) for f in quality_rules.FIGURES} for _ in range(250)]
    for r in rows:
        r["bad"] = int(r["bang_share"] + draw.random() / 3 > 0.8)
    (rule,) = quality_rules._grow(rows)
    inside = [r for r in rows if rule.holds(r)]
    b, bad = sum(r["bad"] for r in inside), sum(r["bad"] for r in rows)
    gain, _ = brute_first_condition(rows)
    assert math.isclose(b * (math.log2(b / len(inside)) - math.log2(bad / len(rows))), gain)


@pytest.mark.parametrize("n", [100, 6000])
def test_few_bad_rows_behind_a_tie_are_found(n):
    """Nearly all rows share one value; the cut lies just beside it."""
    draw = random.Random(3)
    rows = [{f: draw.random() for f in quality_rules.FIGURES} | {"symbol_share": 0.0, "bad": 0} for _ in range(n)]
    for r in draw.sample(rows, 40):
        r.update(symbol_share=draw.uniform(0.01, 0.5), bad=1)
    rules = quality_rules.cover(rows)
    assert rules and all(any(all(c.holds(r) for c in rule) for rule in rules) == bool(r["bad"]) for r in rows)


def test_learning_copes_with_gaps(spark):
    docs = spark.createDataFrame([(1, "a " * 60), (1, "b " * 60), (None, "c"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    assert quality_rules.learn(docs, labels) == [] == quality_rules.learn(docs, labels.limit(0))
