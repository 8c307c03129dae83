"""Readers, writers, the incremental index, and streams over folders."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from sparvane.plans import registry
from sparvane.sources import files, http
from sparvane.streaming import streams


def test_json_files_keep_broken_ones(spark, tmp_path):
    (tmp_path / "a").mkdir()
    good = {"name": "x", "nodes": [{"id": "1", "name": "n", "type": "t", "typeVersion": 1, "parameters": {"k": "v"}}], "connections": {"n": {}}}
    (tmp_path / "a" / "one.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "a" / "two.json").write_text('{"name": "cut')
    (tmp_path / "a" / "skip.txt").write_text("no")
    rows = {r["file"].rsplit("/", 1)[1]: r for r in files.read_json_files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"one.json", "two.json"}
    assert rows["one.json"]["nodes"][0]["parameters"] == {"k": "v"} and rows["one.json"]["_corrupt_record"] is None
    assert rows["two.json"]["_corrupt_record"] and files.count_files(spark, str(tmp_path)) == 2
    first = files.first_files(spark.createDataFrame([("c", "b"), ("c", "a"), ("d", "z")], "cat string, file string"), "cat", 1)
    assert sorted(tuple(r) for r in first.collect()) == [("c", "a"), ("d", "z")]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet", "orc", "xml"])
def test_formats(spark, tmp_path, kind):
    frame = spark.createDataFrame([(1, "a"), (2, "b, c")], "id int, t string")
    options = {"rowTag": "row"} if kind == "xml" else {}
    files.convert_to_file(frame, str(tmp_path / "x"), kind, **options)
    back = files.extract_from_file(spark, str(tmp_path / "x"), kind, "id int, t string", **options)
    assert sorted(tuple(r) for r in back.select("id", "t").collect()) == [(1, "a"), (2, "b, c")]


def test_binary_files(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.bin", b"\x00\xff"), ("y.txt", b"y"), (None, b"z"), ("n", None)], "path string, content binary")
    done = files.write_files(rows, f"file://{tmp_path}/out")
    assert sorted(tuple(r) for r in done.collect()) == sorted(tuple(r) for r in done.collect()) == [("a/x.bin", 2), ("y.txt", 1)]
    back = files.extract_from_file(spark, str(tmp_path / "out"), "binaryFile", recursiveFileLookup="true")
    assert {r["path"].split("/out/")[1]: bytes(r["content"]) for r in back.collect()} == {"a/x.bin": b"\x00\xff", "y.txt": b"y"}
    with pytest.raises(Exception, match="not below"):
        files.write_files(rows.selectExpr("'../up' AS path", "content"), f"file://{tmp_path}/out").count()


def test_incremental_index(spark):
    schema = "filename string, body string, error string"
    old = files.fingerprint(spark.createDataFrame([("a", "1", None), ("b", "2", None)], schema), ["body"])
    new = files.fingerprint(spark.createDataFrame([("a", "1", None), ("b", "3", None), ("c", "4", None), ("d", None, "broken")], schema), ["body"])
    fresh, counts = files.index_files(new, old)
    assert sorted(r["filename"] for r in fresh.collect()) == ["b", "c"] and tuple(counts.first()) == (2, 1, 1, 4)
    assert tuple(files.index_files(new, old, force=True)[1].first()) == (3, 0, 1, 4)
    assert tuple(files.index_files(new.limit(0), None)[1].first()) == (0, 0, 0, 0)


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><link>l</link></item><item><title>B</title></item></channel></rss>")
    assert sorted((r["title"], r["link"]) for r in files.read_feed(spark, str(tmp_path / "f.xml")).collect()) == [("A", "l"), ("B", None)]


def test_paged_source():
    reader = http.PagedReader({"url": "x/{page}", "pages": "5", "pagespartition": "2"}, lambda url: json.dumps([{"u": url}]))
    parts = reader.partitions()
    assert len(parts) == 3 and [x for p in parts for x in reader.read(p)] == [(k, json.dumps({"u": f"x/{k}"})) for k in range(5)]


START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def events(spark, minutes):
    data = [(k, START + dt.timedelta(minutes=m), "u", float(m)) for k, m in enumerate(minutes)]
    return spark.createDataFrame(data, "id int, ts timestamp, user string, value double")


def test_stream_windows_and_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = events(spark, [0]).schema
    for batch in ([1, 2, 11], [60], [3, 61]):  # minute 3 comes after the watermark has passed it
        events(spark, batch).coalesce(1).write.mode("append").parquet(source)
        counted = streams.tumbling_counts(streams.file_stream(spark, source, schema), "ts", ["user"], "10 minutes", "value", late="5 minutes")
        streams.run_available(counted, out, str(tmp_path / "state"))
    got = {r["window_start"].minute: r["n"] for r in spark.read.parquet(out).where("window_start < timestamp'2024-01-01 01:00:00'").collect()}
    assert got == {0: 2, 10: 1}


def test_stream_dedup_errors_and_upserts(spark, tmp_path):
    source = str(tmp_path / "in")
    frame = events(spark, [1, 2, 3])
    frame.union(frame).coalesce(1).write.parquet(source)
    stream = lambda: streams.file_stream(spark, source, frame.schema)
    once = streams.to_table(streams.stream_dedup(stream(), ["id"], "ts", "1 hour").select("id"), "once")
    assert sorted(r["id"] for r in once.collect()) == [0, 1, 2]
    good, bad, latest = [], [], []
    streams.split_errors(stream(), F.col("value") > 2, lambda b, n: good.extend(b.collect()), lambda b, n: bad.extend(b.collect()), str(tmp_path / "e"))
    assert len(good) == 4 and {r["id"] for r in bad} == {2}
    streams.upsert_batches(stream(), lambda b, n: latest.extend(b.collect()), ["user"], "ts", str(tmp_path / "u"))
    assert [r["id"] for r in latest] == [2]


def test_table_streams_of_a_file_and_of_a_folder(spark, tmp_path):
    query = registry.queries()["error_stream"]
    runs = [(k, "t", ["timeout after 5 s", "refused", None][k % 3]) for k in range(230)]
    frame = spark.createDataFrame(runs, "run_id long, test string, error string")
    want = sorted(((*r, bool(r[2]) and r[2].startswith("timeout")) for r in runs))
    (tmp_path / "many").mkdir()
    frame.repartition(120).write.parquet(str(tmp_path / "many" / "timing.parquet"))  # more files than one batch takes
    frame.coalesce(1).write.parquet(str(tmp_path / "part"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "part").glob("*.parquet")).rename(tmp_path / "one" / "timing.parquet")
    frame.limit(1).coalesce(1).write.parquet(str(tmp_path / "one" / "other.parquet"))
    for kind in ("many", "one"):
        assert sorted(tuple(r) for r in query(spark, str(tmp_path / kind)).collect()) == want


def test_sessions(spark):
    got = streams.session_windows(events(spark, [0, 5, 30]), "ts", ["user"], "10 minutes").orderBy("session_start").collect()
    assert [r["n"] for r in got] == [2, 1]


def test_wait_holds_rows(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int").coalesce(1).write.parquet(str(tmp_path / "in"))
    held = streams.wait(streams.file_stream(spark, str(tmp_path / "in"), "k string, v int"), "k", 1500)
    query = held.writeStream.format("memory").queryName("held").outputMode("append").trigger(processingTime="1 second").start()
    try:
        began = time.time()
        while spark.table("held").count() < 3 and time.time() - began < 60:
            time.sleep(0.5)
        # The batch that reads the rows gives none; a later one does.
        assert query.recentProgress[0]["numInputRows"] == 3 and query.recentProgress[0]["sink"]["numOutputRows"] <= 0
        assert sorted(r["row"] for r in spark.table("held").collect()) == ['{"k":"a","v":1}', '{"k":"a","v":2}', '{"v":3}']
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
