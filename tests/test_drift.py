"""Schema drift: the changes of each file, the union schema, and one table out of all layouts."""

import datetime as dt
import json

from sparvane.operators import drift

LAYOUT = [
    ("file", "name", "string", True), ("file", "active", "boolean", True), ("file", "nodes", "array", True), ("file", "connections", "object", True),
    ("file", "createdAt", "string", True), ("file", "updatedAt", "string", True), ("file", "settings", "object", False), ("file", "staticData", "object", False),
    ("file", "tags", "array", False), ("node", "id", "string", True), ("node", "name", "string", True), ("node", "typeVersion", "number", True),
    ("node", "disabled", "boolean", False), ("link", "node", "string", True), ("link", "type", "string", True), ("link", "index", "number", True),
]
GOOD = {"name": "x", "active": True, "nodes": [], "connections": {}, "createdAt": "a", "updatedAt": "b"}


def frames(spark, bodies):
    day = dt.datetime(2024, 1, 1)
    rows = [(k, "r", f"p{k}", day + dt.timedelta(k), day + dt.timedelta(k + 1), b, "clash", 1) for k, b in bodies]
    files = spark.createDataFrame(rows, "raw_id long, repo string, path string, exported_at timestamp_ntz, loaded_at timestamp_ntz, body string, level string, _n int")
    return files, spark.createDataFrame(LAYOUT, "level string, field string, json_type string, required boolean")


def link(**x):
    return GOOD | {"connections": {"a": {"main": [[x], None, [None, 3]], "odd": None}}}


def test_changes(spark):
    bodies = [
        (1, json.dumps(GOOD)),
        (2, json.dumps({k: v for k, v in GOOD.items() if k != "name"} | {"title": "t"})),
        (3, json.dumps({k: v for k, v in GOOD.items() if k != "name"} | {"meta": {}})),
        (4, json.dumps(GOOD | {"active": 1, "settings": None, "tags": "a", "Extra": None})),
        (5, json.dumps(GOOD | {"nodes": [{"id": "1", "displayName": "n", "typeVersion": "2"}, 7, None]})),
        (6, json.dumps(GOOD | {"nodes": {"id": 1}})),
        (7, json.dumps(link(port="main", node="b", index=0, label="l"))),
        (8, json.dumps(link(port="main", node="b", index=0))),
        (9, json.dumps(link(type="main", node="b", index=0, label="l"))),
        (10, None), (11, ""), (12, "{"), (13, "[1]"), (14, "null"),
        (1, json.dumps(GOOD)),
    ]
    files, layout = frames(spark, bodies)
    got = {tuple(r)[:4] for r in drift.changes(files, layout).collect()}
    assert got == {
        (2, "file", "name", "renamed"),
        (3, "file", "name", "removed"), (3, "file", "meta", "added"),
        (4, "file", "active", "retyped"), (4, "file", "tags", "retyped"), (4, "file", "Extra", "added"),
        (5, "node", "name", "renamed"), (5, "node", "typeVersion", "retyped"),
        (6, "file", "nodes", "retyped"),
        (7, "link", "type", "renamed"), (7, "link", "label", "added"), (8, "link", "type", "renamed"), (9, "link", "label", "added"),
    }
    log = drift.change_log(files, layout).collect()
    assert [r["first_seen"] for r in log] == sorted(r["first_seen"] for r in log)
    assert {(r["level"], r["field"], r["change"]): r["n_files"] for r in log}["link", "type", "renamed"] == 2
    table = {r["raw_id"]: r for r in drift.uniform(files, layout).collect()}
    assert set(table) == set(range(1, 10))
    assert table[2]["name"] == "t" and table[4]["active"] is True and table[3]["extra"] == '{"meta": {}}'
    assert table[5]["nodes"][0]["name"] == "n" and table[5]["nodes"][0]["type_version"] == 2.0
    assert table[7]["links"][0]["type"] == "main" and table[7]["links"][0]["source"] == "a"


def test_lattice_is_one():
    kinds = drift.LATTICE
    for a in kinds:
        assert drift.promote(a, a) == a and drift.promote(a, "null") == a
        for b in kinds:
            assert drift.promote(a, b) == drift.promote(b, a)
            for c in kinds:
                assert drift.promote(drift.promote(a, b), c) == drift.promote(a, drift.promote(b, c))


def test_union_schema_and_empty(spark):
    files, layout = frames(spark, [(1, '{"a": 1}'), (2, '{"a": "x"}'), (3, '{"a": null, "b": [1]}'), (4, '{"b": {}}'), (5, '{"c": true, "name": "n"}'), (6, '{"c": 2}')])
    agreed = drift.Layout.read(layout)
    got = {r["field"]: (r["json_type"], r["agreed"]) for r in drift.union_schema(files, agreed).collect()}
    assert got == {"a": ("string", False), "b": ("string", False), "c": ("number", False), "name": ("string", True)}
    assert drift.changes(files.limit(0), layout).count() == 0 and drift.uniform(files.limit(0), layout).count() == 0


def test_table_keeps_what_has_no_place(spark):
    bodies = [
        (1, json.dumps(GOOD | {"nodes": [{"id": "1", "name": "n", "typeVersion": "two", "color": 3, "disabled": None}, 7], "active": "maybe"})),
        (2, json.dumps(GOOD | {"nodes": {"id": 1}, "connections": [1]})),
        (3, json.dumps(link(node="b", type="main", index=0, label="l"))),
        (4, json.dumps(GOOD | {"active": "yes", "tags": "a"})),
    ]
    files, layout = frames(spark, bodies)
    table = {r["raw_id"]: r for r in drift.uniform(files, layout).collect()}
    told = {k: json.loads(r["extra"]) if r["extra"] else None for k, r in table.items()}
    assert told == {
        1: {"active": "maybe", "nodes": json.loads(bodies[0][1])["nodes"]},
        2: {"nodes": {"id": 1}, "connections": [1]},
        3: {"connections": json.loads(bodies[2][1])["connections"]},
        4: None,
    }
    assert json.loads(table[1]["nodes"][0]["extra"]) == {"typeVersion": "two", "color": 3}
    assert json.loads(table[3]["links"][0]["extra"]) == {"label": "l"} and table[4]["active"] is True and table[4]["tags"] == '"a"'


def test_columns_come_from_the_layout(spark):
    """A field agreed on later has its column, at every level; without it, it is kept beside its object."""
    body = GOOD | {"ownerTeam": "t", "nodes": [{"id": "1", "name": "n", "typeVersion": 1, "retryCount": 3}]}
    files, _ = frames(spark, [(1, json.dumps(body))])
    more = [*LAYOUT, ("file", "ownerTeam", "string", False), ("node", "retryCount", "number", False)]
    layout = spark.createDataFrame(more, "level string, field string, json_type string, required boolean")
    row = drift.uniform(files, layout).first()
    assert (row["owner_team"], row["nodes"][0]["retry_count"], row["extra"], row["nodes"][0]["extra"]) == ("t", 3.0, None, None)


def test_the_most_frequent_stand_in_wins(spark):
    """Of two unknown fields that could stand in, the one that mostly does so elsewhere, whatever their order."""
    short = {k: v for k, v in GOOD.items() if k != "name"}
    bodies = [(k, json.dumps(short | {"title": "t"})) for k in range(5)] + [(k, json.dumps(GOOD | {"note": "x"})) for k in range(5, 9)]
    bodies += [(9, json.dumps(short | {"note": "x", "title": "t"}))]
    files, layout = frames(spark, bodies)
    got = {tuple(r) for r in drift.changes(files, layout).where("raw_id = 9").collect()}
    assert got == {(9, "file", "name", "renamed", "title"), (9, "file", "note", "added", "string")}


def test_odd_bodies(spark):
    """Lone surrogates become U+FFFD, numbers of any length are numbers, what only looks like JSON is broken, deep nesting too."""
    good = json.dumps(GOOD)[:-1]
    bodies = [
        (1, good + ', "k\\ud800": "v\\udfff", "e": "\\ud83d\\ude00"}'), (2, good + f', "big": {"9" * 6000}}}'), (3, good + ', "n": NaN}'), (4, '{"a":' * 100_000 + "1" + "}" * 100_000),
        (5, good + ', "tags": [1, 1]}'), (6, ""), (7, " "),
    ]
    files, layout = frames(spark, bodies)
    got = {tuple(r) for r in drift.changes(files, layout).collect()}
    assert got == {(1, "file", "k\ufffd", "added", "string"), (1, "file", "e", "added", "string"), (2, "file", "big", "added", "number")}
    table = {r["raw_id"]: r for r in drift.uniform(files, layout).collect()}
    assert set(table) == {1, 2, 5} and json.loads(table[1]["extra"]) == {"k\ufffd": "v\ufffd", "e": "\U0001f600"} and table[5]["tags"] == "[1,1]"
