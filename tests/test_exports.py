import glob

from pyspark.sql import functions as F

from crawlweave.operators import counters, exports
from crawlweave.session import new_path
from crawlweave.sources.buffer import Buffer


def test_csv_bytes(spark, tmp_path):
    rows = [(1, 0, "http://h/a,b?q=1"), (2, 3, 'http://h/"x"'), (3, 1, "line\nfeed"), (4, 0, "http://H/%C3%A9")]
    df = spark.createDataFrame(rows, "seq int, depth int, url string")
    out = str(tmp_path / "csv")
    exports.write_csv(df, out, order="seq", single_file=True)
    data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(out + "/part-*")))
    # a quote is no legal URI character, so that row has no host and path
    assert data.decode() == (
        '0,"http://h/a,b?q=1",h,"/a,b?q=1"\r\n3,"http://h/""x""",,\r\n1,"line\nfeed",,\r\n0,http://H/%C3%A9,H,/é\r\n'
    )


def test_header_part(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "http://h/a")], "seq int, depth int, url string")
    out = str(tmp_path / "csv")
    exports.write_csv_with_header(df, out)
    assert [r["line"] for r in exports.read_export(spark, out).orderBy("place").collect()] == ["depth,url,host,path", "0,http://h/a,h,/a"]


def test_clear_takes_exactly_what_was_exported(spark):
    """Messages that arrive between the snapshot and the clearing stay, also while another clearing goes on."""
    buffer = Buffer(spark, new_path(spark, "buffer"), "seq bigint, value string")
    put = lambda *seqs: buffer.append(spark.createDataFrame([(i, f"1|http://h/{i}") for i in seqs], buffer.schema))
    held = lambda: sorted(r.seq for r in buffer.read().collect())
    assert held() == [] and buffer.snapshot() == []
    put(1, 2)
    put(3)
    mark, target = buffer.snapshot(), new_path(spark, "export")
    put(4)
    snapshot = exports.export_and_clear(buffer, target, mark)
    assert sorted(r.seq for r in snapshot.collect()) == [1, 2, 3] and held() == [4]
    assert {r[0] for r in spark.read.text(target).collect()} == {f"1,http://h/{i},h,/{i}" for i in (1, 2, 3)}
    one, two = buffer.snapshot(), buffer.snapshot()
    put(5)
    buffer.clear(one)
    buffer.clear(two)  # a second reader with the same mark
    assert held() == [5]
    exports.export_and_clear(buffer, new_path(spark, "export"))
    assert held() == [] and buffer.count() == 0
    buffer.append(spark.createDataFrame([(7, "bad|http://h/b")], buffer.schema))
    last = new_path(spark, "export")
    exports.export_and_clear(buffer, last)
    assert [r[0] for r in spark.read.text(last).collect()] == ["0,http://h/b,h,/b"]
    put(6)
    assert held() == [6] and len(buffer._names("batches")) == 2  # and the folder that was cleared last


def test_last_n_keeps_the_newest(spark):
    feed = spark.range(250).withColumnRenamed("id", "seq")
    kept = {r["seq"] for r in exports.last_n(feed, "seq", 200).collect()}
    assert kept == set(range(50, 250))
    assert exports.last_n(spark.range(12_000).toDF("seq"), "seq", 50_000).count() == 12_000


def test_first_error_alerts_once(spark):
    rows = [(1, 1, False), (1, 2, True), (1, 2, True), (1, 3, False), (1, 4, True)]
    df = spark.createDataFrame(rows, "crawl_id int, batch int, failed boolean")
    got = counters.sink_errors(df, ("crawl_id",), "batch", F.col("failed")).orderBy("batch").collect()
    assert [(r["errors"], r["total_errors"], r["alert"]) for r in got] == [(0, 0, False), (2, 2, True), (0, 2, False), (1, 3, False)]


def test_state_json_escapes(spark):
    df = spark.createDataFrame([('a"b\\c\n\r',)], "seed string")
    record = counters.state_json(F.lit(5), F.lit(0), F.col("seed"), F.lit(True))
    assert df.select(record).first()[0] == '{"startMs":5,"endMs":0,"seedUrl":"a\\"b\\\\c\\n\\r","paused":true}'
