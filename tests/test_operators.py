"""The general operators on small frames: nulls, ties, repeated rows, empty inputs, and some laws."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparvane.functions import codes, text
from sparvane.operators import catalog, digest, relational, search, shape, vector


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_compare_datasets_covers_all_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, "w"), (None, "n")], "k int, v string")
    got = {r["k"]: r["status"] for r in relational.compare_datasets(a, b, ["k"]).collect()}
    assert got == {1: "same", 2: "same", 3: "different", 4: "only_b", None: "same"}
    assert {r["k"]: r["action"] for r in relational.sync_plan(a, b, ["k"]).collect()} == {3: "update", 4: "delete"}
    assert relational.compare_datasets(a.limit(0), b.limit(0), ["k"]).count() == 0


def test_merges(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (None, "y"), (2, "x")], "k int, v string")
    assert rows(relational.merge_by_key(a, b, ["k"])) == [(1, "a", "z"), (1, "b", "z")]
    assert relational.merge_by_key(a, b, ["k"], "full_outer").count() == 5
    for wrong in ({"how": "sideways"}, {"hint": "broadcast"}):
        with pytest.raises(ValueError):
            relational.merge_by_key(a, b, ["k"], **wrong)
    assert rows(relational.merge_by_key(a, b, ["k"], hint="shuffle_hash")) == [(1, "a", "z"), (1, "b", "z")]
    assert relational.merge_append(a, b.drop("v")).where("v is null").count() == 3


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), max_size=40))
def test_position_and_batches(spark, values):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, v int").repartition(3)
    order = [F.col("v"), F.col("id")]
    placed = {r["id"]: r["position"] for r in relational.with_position(frame, order).collect()}
    assert placed == {k: p for p, (v, k) in enumerate(sorted((v, k) for k, v in enumerate(values)))}
    sizes = [r["count"] for r in shape.split_in_batches(frame, 7, order).groupBy("batch").count().collect()]
    assert sorted(sizes, reverse=True) == [7] * (len(values) // 7) + ([len(values) % 7] if len(values) % 7 else [])


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_positions_of_rows_with_payload(spark, adaptive):
    """More rows than the range sampler takes, wide ones, ties, and many partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "48")
        n = 200_000
        frame = spark.range(n).select("id", F.xxhash64("id").alias("key"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"), F.lit(1).alias("_part"))
        placed = relational.with_position(frame, [F.col("key")])
        assert placed.columns == [*frame.columns, "position"]
        assert placed.agg(F.count("*"), F.count_distinct("position"), F.min("position"), F.max("position")).first()[:] == (n, n, 0, n - 1)
        assert placed.join(placed.selectExpr("position + 1 AS position", "key AS before"), "position").where("key < before").count() == 0
        both = relational.merge_by_position(frame, frame, [F.col("key")], [F.col("key")])
        assert both.agg(F.count("*"), F.count_if(F.col("id") == F.col("id_right"))).first()[:] == (n, n)
        tied = relational.with_position(frame, [F.lit(1)])
        assert tied.agg(F.count_distinct("position"), F.max("position")).first()[:] == (n, n - 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_branches_partition_the_input(spark):
    frame = spark.createDataFrame([(k, [True, False, None][k % 3]) for k in range(9)], "id int, c boolean")
    yes, no = shape.if_branch(frame, F.col("c"))
    assert yes.count() == 3 and no.count() == 6 and yes.union(no).distinct().count() == 9
    routed = shape.switch_route(frame, [("t", F.col("c")), ("three", F.col("id") == 3), ("one", F.col("id") == 1)])
    assert {r["id"]: r["route"] for r in routed.collect()}[3] == "t" and routed.where("route = 'fallback'").count() == 5


def test_split_and_aggregate_are_inverse(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (4, ["c"])], "id int, x array<string>")
    out = shape.split_out(frame, "x")
    assert out.count() == 3 and shape.split_out(frame, "x", keep_empty=True).count() == 5
    assert rows(shape.aggregate_items(out, "x", ["id"], "x")) == [(1, ["a", "b"]), (4, ["c"])]
    with pytest.raises(Exception, match="too small"):
        shape.stop_on(frame, F.col("id") < 2, "too small").collect()


def test_order_and_duplicates(spark):
    frame = spark.createDataFrame([(1, "b", None), (2, "a", 3), (3, "a", 1), (4, None, 1)], "id int, k string, v int")
    assert [r["id"] for r in shape.sort_items(frame, ("v", False), ("id", True)).collect()] == [2, 3, 4, 1]
    assert rows(relational.remove_duplicates(frame, ["k"], [F.col("id").desc()]).select("id")) == [(1,), (3,), (4,)]
    assert {r["id"]: r["k"] for r in shape.dedupe_suffix(frame, "k", [F.col("id")]).collect()} == {1: "b", 2: "a", 3: "a 2", 4: None}
    assert [r["id"] for r in shape.limit_items(frame, 2, [("id", True)], last=True).collect()] == [4, 3]


def test_asof_and_range(spark):
    left = spark.createDataFrame([("u", 5, 1), ("u", 1, 2), ("w", 9, 3)], "by string, t int, id int")
    right = spark.createDataFrame([("u", 2, 20), ("u", 5, 50), ("u", 7, 70)], "by string, t int, v int")
    assert {r["id"]: r["v"] for r in relational.asof_join(left, right, ["by"], "t", ["v"]).collect()} == {1: 50, 2: None, 3: None}
    points = spark.createDataFrame([(k,) for k in range(20)], "p int")
    ranges = spark.createDataFrame([("a", 3, 9), ("b", 8, 8), ("c", 0, 20)], "n string, s int, e int")
    got = rows(relational.range_join(points, ranges, "p", "s", "e", 4).select("n", "p"))
    assert got == sorted([("a", p) for p in range(3, 9)] + [("c", p) for p in range(20)], key=repr)


def test_search(spark):
    frame = spark.createDataFrame([(1, "Telegram bot, telegram!"), (2, "telegrams"), (3, None), (4, ""), (5, "a bot")], "id int, t string")
    assert [r["id"] for r in search.match_term(frame, "t", "TELEGRAM").collect()] == [1]
    assert rows(search.postings(frame, "id", "t")) == [("a", 5, 1), ("bot", 1, 1), ("bot", 5, 1), ("telegram", 1, 2), ("telegrams", 2, 1)]
    scores = {r["id"]: r["score"] for r in search.bm25(frame, "id", "t", ["bot", "telegram"]).collect()}
    assert set(scores) == {1, 5} and scores[1] > scores[5] > 0
    assert search.bm25(frame.limit(0), "id", "t", ["bot"]).count() == 0


def test_written_index_answers_as_the_scan(spark, tmp_path):
    frame = spark.createDataFrame([(k, f"word{k % 7} Common, x{k}") for k in range(60)], "id int, t string")
    search.write_postings(search.postings(frame, "id", "t"), str(tmp_path / "index"), buckets=8)
    index = spark.read.parquet(str(tmp_path / "index"))
    for term in ("Word3", "common", "x59", "absent"):
        found = search.look_up(index, term, buckets=8)
        assert rows(found.select("id")) == rows(search.match_term(frame, "t", term).select("id"))
    plan = search.look_up(index, "common", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_item_lists_dispatch(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (1, ["b"]), (2, None)], "k int, x array<string>")
    out = shape.item_lists(frame, "split_out", field="x")
    assert out.count() == 3 and shape.item_lists(out, "remove_duplicates", keys=["k", "x"]).count() == 2
    assert [r["x"] for r in shape.item_lists(out, "sort", keys=[("x", False), ("k", True)]).limit(1).collect()] == ["b"]


def test_vectors(spark):
    data = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.1], "a"), (3, [0.0, 1.0], "b"), (4, [0.0, 0.0], "b"), (5, None, "b"), (6, [1.0], "b"), (7, [0.0, 1.0], "b")]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label string")
    near = [tuple(r)[:2] for r in vector.top_k(frame, frame.where("vec_id = 3"), 2).orderBy("rank").collect()]
    assert near == [(3, 7), (3, 2)]
    assert rows(vector.knn_classify(frame, frame.where("vec_id = 1"), 1).select("query_id", "predicted")) == [(1, "a")]
    assert vector.top_k(frame, frame.limit(0), 2).count() == 0
    unit = spark.createDataFrame([("a b a",)], "t string").select(vector.embed_hashed(F.col("t"), 8).alias("v")).first()["v"]
    assert len(unit) == 8 and abs(sum(x * x for x in unit) - 1) < 1e-5


def test_catalog(spark):
    schema = "wf_id long, active boolean, node_count int, last_indexed timestamp_ntz, integrations array<string>, trigger_type string, complexity string"
    now = dt.datetime(2024, 1, 1)
    data = [(1, True, 3, now, ["a", "b", ""], "Webhook", "low"), (2, None, None, None, None, None, "low"), (3, False, 4, now, ["a"], "Manual", None)]
    one = catalog.catalog_stats(spark.createDataFrame(data, schema)).first()
    assert (one["total"], one["active"], one["inactive"], one["unique_integrations"], one["total_nodes"]) == (3, 1, 1, 2, 7)
    assert one["triggers"] == {"Webhook": 1, "Manual": 1} and one["complexity"] == {"low": 2}
    empty = catalog.catalog_stats(spark.createDataFrame([], schema)).first()
    assert empty["total"] == 0 and empty["total_nodes"] == 0 and empty["triggers"] == {}
    graded = spark.createDataFrame([(9.9,), (10.0,), (50.0,), (None,)], "x double").select(catalog.grade(F.col("x"), [(10.0, "a"), (50.0, "b")], "c"))
    assert [r[0] for r in graded.collect()] == ["a", "b", "c", None]


def test_text_functions(spark):
    data = [("a,b, ,c,", "['GET', 'PUT']", "abcdefghij"), (None, None, None), ("", "POST", "")]
    frame = spark.createDataFrame(data, "l string, m string, t string")
    got = [tuple(r) for r in frame.select(text.split_comma_list(F.col("l")), text.parse_list_literal(F.col("m")), text.chunk_fixed(F.col("t"), 4, 1)).collect()]
    assert got == [(["a", "b", "c"], ["GET", "PUT"], ["abcd", "defg", "ghij"]), (None, None, None), ([], ["POST"], [])]
    long = "First part. " * 30 + "\n\n" + "x" * 300
    chunks = spark.createDataFrame([(long,)], "t string").select(text.chunk_recursive(F.col("t"), 100).alias("c")).first()["c"]
    assert "".join(chunks) == long and max(map(len, chunks)) <= 100
    page = "<html><head><title>T &amp; U</title><script>no</script></head><body><p>One <b>two</b><p>three<a href='/x'>l</a>"
    one = spark.createDataFrame([(page,), (None,), ("<",)], "p string").select(text.html_extract(F.col("p")).alias("h")).collect()
    assert one[0]["h"].asDict() == {"title": "T & U", "text": "One two\nthreel", "links": ["/x"]} and one[1]["h"] is None
    marked = spark.createDataFrame([("# A\n\nx **b** `c<d`\n\n- i\n- j\n\n```\nq\n```",)], "t string").select(text.markdown_to_html(F.col("t"))).first()[0]
    assert marked == "<h1>A</h1>\n<p>x <strong>b</strong> <code>c&lt;d</code></p>\n<ul><li>i</li><li>j</li></ul>\n<pre><code>q</code></pre>"
    names = spark.createDataFrame([("0042_Slack_Gmail_Create_Webhook.json",), ("odd.json",)], "f string").select(text.filename_parts(F.col("f")).alias("p")).collect()
    assert tuple(names[0]["p"]) == (42, "Slack_Gmail", "Create", "Webhook") and names[1]["p"]["number"] is None
    cal = spark.createDataFrame([("Cal.com call",), ("CalcsLive",)], "t string").select(text.brand_match(F.col("t"), "cal", ["calcslive"])).collect()
    assert [r[0] for r in cal] == [True, False]


def test_codes(spark):
    assert codes.one_time_code(b"12345678901234567890", 59, 8) == "94287082"
    out = spark.createDataFrame([("what do ya want for nothing?", 59), (None, None)], "m string, s long")
    got = out.select(codes.hmac_hex(F.col("m"), b"Jefe"), codes.totp(F.col("s"), b"12345678901234567890", 8)).collect()
    assert got[0][0] == "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843" and got[0][1] == "94287082" and tuple(got[1]) == (None, None)


def test_digest(spark):
    data = [(1, "Acme 财报 report", "s", "2024-01-15", "u", "Acme"), (2, "acme launches", "s", "2024-01-15", "u<", "Acme"), (3, None, "s", "2024-01-14", "u", None)]
    records = spark.createDataFrame(data, "id int, summary string, source string, publish_date string, url string, company string")
    rules = [("financial_reports", ["财报"]), ("product_launches", ["launch"])]
    records = records.withColumn("category", digest.classify(F.col("summary"), rules))
    assert [r["category"] for r in records.orderBy("id").collect()] == ["financial_reports", "product_launches", "unknown"]
    assert tuple(digest.digest_counts(records).first()) == (3, 3, 1)
    page = digest.render_text(records, "2024-01-15").first()
    assert page["text"].index("financial_reports") < page["text"].index("product_launches") and "u&lt;" in page["html"]
    companies = spark.createDataFrame([("Acme Inc", "ACME"), ("Other", "other")], "company string, token string")
    assert rows(digest.match_companies(records, companies, "id", "summary")) == [(1, "Acme Inc"), (2, "Acme Inc")]


def test_filename_numbers_of_any_length(spark):
    names = ["24463_Kelvano_Import_Manual.json", "7_a_b.json", "0042.json", "x_y.json", "123456789012_S_Do_It.json"]
    rows = spark.createDataFrame([(n,) for n in names], "f string").select(text.filename_parts(F.col("f")).alias("p")).collect()
    assert [tuple(r["p"]) for r in rows] == [
        (24463, "Kelvano", "Import", "Manual"), (7, "", "a", "b"), (42, None, None, None), (None, "", "x", "y"), (123456789012, "S", "Do", "It"),
    ]


def test_url_parts_of_every_url(spark, tmp_path):
    from sparvane.plans import registry

    urls = ["https://a.example/b/c?x=1&y=2", "HTTP://me:pw@A.example:8080/B?q", "ftp://a.example", "https://a.example/b#end", "no url at all", None]
    want = [("https", "a.example", "/b/c", "x=1&y=2"), ("HTTP", "A.example", "/B", "q"), ("ftp", "a.example", "", None), ("https", "a.example", "/b", None), (None,) * 4]
    nodes = [{"parameters": {"url": u}} for u in urls]
    spark.createDataFrame([(1, nodes)], "file_id long, nodes array<struct<parameters:map<string,string>>>").write.parquet(f"{tmp_path}/workflow_json.parquet")
    got = sorted((tuple(r) for r in registry.queries()["url_parts"](spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == [(1, k, *w) for k, w in enumerate(want)]


def test_windows_over_slices(spark, monkeypatch):
    """As-of, rolling lists and suffixes with one hot key, cut into slices of a few rows, against plain Python."""
    monkeypatch.setattr(relational, "SLICE_ROWS", 7)
    monkeypatch.setattr(shape, "SLICE_ROWS", 7)
    rnd = random.Random(3)
    key = lambda: rnd.choice(["hot"] * 8 + ["b", "c", None])
    left = [(key(), rnd.randrange(60), k) for k in range(90)]
    right = [(b, t, f"v{k}") for k, (b, t) in enumerate({(key(), rnd.randrange(60)) for _ in range(25)})] + [("hot", 30, None)]
    a, b = spark.createDataFrame(left, "by string, t int, id int"), spark.createDataFrame(right, "by string, t int, v string")
    b = b.where("t != 30 or v is null")
    at = {(x["by"], x["t"]): x["v"] for x in b.collect()}
    want = {i: at[max(k for k in at if k[0] == by and k[1] <= t)] if any(k[0] == by and k[1] <= t for k in at) else None for by, t, i in left}
    got = relational.asof_join(a, b, ["by"], "t", ["v"])
    assert got.columns == ["by", "t", "id", "v"] and {r["id"]: r["v"] for r in got.collect()} == want
    ordered = sorted(left, key=lambda r: (r[0] or "", r[1], r[2]))
    rolled = {r["id"]: r["window"] for r in shape.rolling_list(a, ["by"], [F.col("t"), F.col("id")], "id", 4).collect()}
    named = {r["id"]: r["by"] for r in shape.dedupe_suffix(a, "by", [F.col("t"), F.col("id")]).collect()}
    for name in ("hot", "b", "c", None):
        own = [i for by, _, i in ordered if by == name]
        assert all(rolled[i] == own[max(0, k - 3) : k + 1] for k, i in enumerate(own))
        assert all(named[i] == (name if name is None or k == 0 else f"{name} {k + 1}") for k, i in enumerate(own))


def test_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector, "QUERY_BYTES", 3 * 8 * 4)
    monkeypatch.setattr(vector, "ROW_BYTES", 5 * 8 * 4)
    monkeypatch.setattr(vector, "_HELD", 20)
    rnd = np.random.default_rng(1)
    rows = [(k, rnd.normal(size=4).round(2).tolist(), k % 3) for k in range(60)] + [(90, None, 0), (91, [], 1), (92, [0.0] * 4, 2), (93, [1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    units = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v, _ in rows[:60]}
    got = {}
    for r in vector.top_k(frame, frame.where("vec_id < 20"), 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
    assert got == {q: dict(enumerate(sorted((i for i in units if i != q), key=lambda i: (-round(float(units[q] @ units[i]), 12), i))[:4], 1)) for q in range(20)}
    assert vector.top_k(frame, frame.limit(0), 4).count() == 0 and vector.top_k(frame.limit(0), frame, 4).count() == 0
    near = {r["vec_id"]: r["distance"] for r in vector.centroid_distance(frame.where("vec_id < 60"), "label").collect()}
    centers = [np.mean([np.array(v, np.float32) for _, v, x in rows[:60] if x == label], axis=0) for label in range(3)]
    assert all(abs(near[i] - min(np.linalg.norm(np.array(v) - c) for c in centers)) < 1e-5 for i, v, _ in rows[:60])
