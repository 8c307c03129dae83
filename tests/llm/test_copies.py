"""Copies against a plain grouping; the ledger in batches against one batch."""

import json
import re
from collections import defaultdict

from sparvane.llm import copies

NODES = "array<struct<id:string,name:string,type:string,type_version:double,parameters:map<string,string>>>"
WORDS = re.compile(r"[^\W_]+")


def bare(s):
    return None if s is None else "".join(WORDS.findall(s.lower()))


def canon(v):
    if isinstance(v, dict):
        return {bare(k): canon(x) for k, x in v.items()}
    return [canon(x) for x in v] if isinstance(v, list) else bare(v) if isinstance(v, str) else v


def node(name, parameters=None, version=1.0, type_="t"):
    return {"id": "i-1", "name": name, "type": type_, "type_version": version, "parameters": parameters}


A = [node("Send Mail", {"Text": "Hello, World", "to": None}), node("x")]
B = [node("send-mail", {"to": None, "TEXT": "hello world"}), node("X!")]
LINKS = {"Send Mail": {"main": [[{"node": "x", "index": 0}], None]}}
FILES = [
    (1, A, json.dumps(LINKS)),
    (2, B, json.dumps({"send mail": {"MAIN": [[{"index": 0.0, "node": "X"}], None]}}, indent=2)),
    (2, B, json.dumps({"send mail": {"MAIN": [[{"index": 0.0, "node": "X"}], None]}}, indent=2)),
    (3, A, json.dumps({"Send Mail": {"main": [None, [{"node": "x", "index": 0}]]}})),
    (4, [node("Send Mail", {"Text": "Hello, World", "to": ""}), node("x")], json.dumps(LINKS)),
    (5, A[::-1], json.dumps(LINKS)),
    (6, [], "{}"), (7, None, "{}"), (8, [], "{}"),
    (9, A, None), (10, B, None), (11, A, '{"cut": '), (12, B, '{"CUT":'), (13, A, ""), (14, A, "null"),
    (15, [None, node(None)], "{}"), (16, [None, node(None)], "{ }"), (17, [node("y", {})], "{}"), (18, [node("y", None)], "{}"),
    (19, [node("点 İ" * 5000, None, None)], "{}"), (20, [node("点İ" * 5000, None, None)], "{}"),
]


def expected(files):
    groups = defaultdict(set)
    for i, nodes, links in files:
        if nodes:
            try:
                told = json.dumps(canon(json.loads(links)), sort_keys=True).replace("0.0", "0") if links is not None else None
            except ValueError:
                told = "!" + bare(links)
            key = json.dumps([n and [bare(n["id"]), bare(n["name"]), bare(n["type"]), n["type_version"], n["parameters"] and canon(n["parameters"]) or n["parameters"]] for n in nodes], sort_keys=True)
            groups[key, told].add(i)
    return {("nodes", min(g), i) for g in groups.values() for i in g if i > min(g)}


def test_found(spark):
    files = spark.createDataFrame([(*f, "clash", 1) for f in FILES], f"file_id long, nodes {NODES}, connections string, key string, n int")
    names = ["A_b.json", "a B json", "A-B JSON!", None, "", "--", "c", None, "C"]
    rows = spark.createDataFrame([(k, n, b"x") for k, n in enumerate(names)] * 2, "wf_id long, filename string, key binary")
    ledger = copies.CopyLedger(spark).absorb(copies.file_keys(files)).absorb(copies.name_keys(rows))
    got = [tuple(r) for r in ledger.copies().collect()]
    want = expected(FILES) | {("filename", 0, 1), ("filename", 0, 2), ("filename", 4, 5), ("filename", 6, 8)}
    assert len(got) == len(set(got)) and set(got) == want
    assert {(r["field"], r["keep_id"]): r["n"] for r in ledger.counts().collect()}["nodes", 1] == 2


def read(ledger):
    return {(r["field"], bytes(r["key"]), r["n"], r["keep_id"]) for r in ledger.counts().collect()}


def test_batches_add_up(spark):
    rows = [("f", k, bytes([k % 13])) for k in range(200)] + [("f", None, b"x"), ("f", 5, None), (None, 1, b"x")]
    frame = spark.createDataFrame(rows, "field string, id long, key binary")
    whole = copies.CopyLedger(spark).absorb(frame)
    parts = copies.CopyLedger(spark, bucket_rows=5)  # splits its buckets as it grows
    for low in (150, 0, 50, 100):
        parts.absorb(frame.where(f"id >= {low} and id < {low + 50}"))
    parts.absorb(frame.limit(0))
    assert read(parts) == read(whole) and len(read(whole)) == 13 and parts.state["count_buckets"] > whole.state["count_buckets"]
    assert copies.CopyLedger(spark).absorb(frame.limit(0)).counts().count() == 0 and copies.CopyLedger(spark).copies().count() == 0


def test_ledger_outlives_its_session(spark):
    frame = spark.createDataFrame([("f", k, bytes([k % 13])) for k in range(200)], "field string, id long, key binary")
    first = copies.CopyLedger(spark).absorb(frame.where("id < 120"), "monday")
    again = copies.CopyLedger(spark, first.path)
    assert read(again) == read(first) and again.state == first.state
    again.absorb(frame.where("id < 120"), "monday")  # by name
    assert again.state == first.state
    again.absorb(frame.where("id between 60 and 150"), "tuesday").absorb(frame, "wednesday")  # ids that come again
    assert read(again) == read(copies.CopyLedger(spark).absorb(frame)) == read(copies.CopyLedger(spark, first.path))
    assert sorted(tuple(r) for r in again.copies().collect()) == sorted(("f", k % 13, k) for k in range(13, 200))
    assert copies.absorb_deliveries(copies.CopyLedger(spark), frame.union(frame)).counts().agg({"n": "sum"}).first()[0] == 200


def test_broken_batch_leaves_no_trace(spark, monkeypatch):
    frame = spark.createDataFrame([("f", k, bytes([k % 3])) for k in range(9)], "field string, id long, key binary")
    ledger = copies.CopyLedger(spark).absorb(frame.where("id < 5"))
    before = read(ledger)
    with monkeypatch.context() as m:
        m.setattr(copies.CopyLedger, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        try:
            ledger.absorb(frame, "broken")
        except OSError:
            pass
    again = copies.CopyLedger(spark, ledger.path)
    assert read(again) == before and again.members().count() == 5
    assert read(again.absorb(frame)) == read(copies.CopyLedger(spark).absorb(frame)) and again.members().count() == 9


def test_ledger_is_not_shuffled(spark):
    frame = spark.createDataFrame([("f", k, bytes([k % 13])) for k in range(200)], "field string, id long, key binary")
    ledger = copies.CopyLedger(spark, bucket_rows=50).absorb(frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        news = frame.groupBy("field", "key").count()
        plan = news.join(ledger.counts(), ["field", "key"], "full_outer")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
