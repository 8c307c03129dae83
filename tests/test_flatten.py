"""Structural indexing and the flat tables, against the standard parser."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from sparvane.operators import flatten
from sparvane.operators.flatten import StructuralIndex

json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=6),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3),
    max_leaves=12,
)


def is_json(text: str) -> bool:
    try:
        json.loads(text, parse_constant=lambda c: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return False
    return True


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(json_values, st.integers(0, 60), st.sampled_from('{}[],:"\\1a tn-. '), st.integers(0, 2)), max_size=12))
def test_validity(cases):
    texts = []
    for value, at, char, how in cases:
        text = json.dumps(value, ensure_ascii=False, indent=[None, 1][at % 2])
        at %= len(text)
        texts += [text, text[:at] + char * (how != 0) + text[at + (how != 1) :], text[:at]]
    index = StructuralIndex([t.encode() for t in texts])
    assert [bool(v) for v in index.valid] == [is_json(t) for t in texts]


def test_odd_texts():
    texts = ["", " ", "null", '"a\\\\"', '{"a":"\\\\"}', '"\\u00e9\\ud83d"', "[1,2]]", '{"a":1}{', "[" * 50 + "]" * 50, '"' + "x" * 100_000 + '"', '{"a":[}]}', "﻿{}"]
    index = StructuralIndex([t.encode() for t in texts])
    assert [bool(v) for v in index.valid] == [is_json(t) for t in texts]
    assert StructuralIndex([]).valid.tolist() == []


def reference(rows):
    """The same tables by plain parsing."""
    out = set()
    for file_id, nodes, connections in rows:
        names = {n["name"] for n in nodes or ()}
        value = json.loads(connections) if connections and is_json(connections) else None
        for source, ports in value.items() if nodes and isinstance(value, dict) else ():
            for slots in ports.values() if isinstance(ports, dict) else ():
                for k, slot in enumerate(slots if isinstance(slots, list) else ()):
                    for x in slot if isinstance(slot, list) else ():
                        if isinstance(x, dict) and isinstance(x.get("node"), str) and {source, x["node"]} <= names:
                            out.add((file_id, "link", source, k, x["node"]))
        for n in nodes or ():
            text = (n["parameters"] or {}).get("rules")
            value = json.loads(text) if text and is_json(text) else None
            for k, rule in enumerate((value.get("values") if isinstance(value, dict) else None) or ()):
                if isinstance(rule, dict) and isinstance(rule.get("id"), str):
                    out.add((file_id, "rule", n["name"], k, rule["id"]))
                    for j, item in enumerate((rule.get("conditions") or {}).get("items") or ()):
                        if isinstance(item, dict) and isinstance(item.get("id"), str):
                            out.add((file_id, "condition", rule["id"], j, item["id"]))
    return out


NODES = "array<struct<id:string,name:string,type:string,type_version:double,parameters:map<string,string>>>"


def node(name, rules=None, **more):
    return {"id": "x", "name": name, "type": "t", "type_version": 1.0, "parameters": ({"rules": rules} if rules is not None else {}) | more}


def test_flatten(spark):
    rules = '{"values": [null, {"id": "r1", "conditions": {"items": [{"id": "c1"}, null, {"id": "c\\u00e9"}]}}, {"id": "r2", "conditions": null}, {"x": 1}]}'
    links = {"a": {"main": [[{"node": "b", "type": "main", "index": 0}], None, [{"node": "a"}, {"node": "zz"}, {"node": {"name": "b"}}]], "ai": None}, "zz": {"main": [[{"node": "a"}]]}}
    many = {"values": [{"id": f"r{k}", "conditions": {"items": [{"id": f"c{k}"}]}} for k in range(3000)]}
    rows = [
        (1, [node("a", rules), node("b", "{broken"), node("b\"q", "")], json.dumps(links)),
        (1, [node("a", rules), node("b", "{broken"), node("b\"q", "")], json.dumps(links)),
        (2, [node("a"), node("b")], json.dumps(links)[:-3]),
        (3, [node("a"), node("b")], "[]"),
        (4, [], json.dumps(links)),
        (5, None, None),
        (6, [node("a", json.dumps(many)), node(None, rules), None], None),
        (7, [node("点"), node('q"')], json.dumps({"点": {"p": [[], [{"index": 1, "node": 'q"'}]]}}, indent=1)),
    ]
    frame = spark.createDataFrame([(*r, "clash", 9) for r in rows], f"file_id long, nodes {NODES}, connections string, child string, slot int")
    got = [tuple(r) for r in flatten.flatten(frame).collect()]
    plain = [(i, [n for n in ns if n] if ns else ns, c) for i, ns, c in rows]
    assert len(got) == len(set(got))
    assert set(got) == reference(plain)
    assert flatten.flatten(frame.limit(0)).count() == 0
    assert flatten.node_table(frame).where("file_id = 2").count() == 2


def test_links_after_any_json_white_space(spark):
    links = '{"a":{"main":[[{"node":"b","type":"main","index":0}]]}}'
    rows = [(k, [("a",), ("b",)], lead + links) for k, lead in enumerate(["", " ", "\n", "\r\n", "\t", " \n\t"])]
    files = spark.createDataFrame(rows, "file_id long, nodes array<struct<name:string>>, connections string")
    assert sorted(r["file_id"] for r in flatten.flatten_links(files).collect()) == list(range(6))


def test_lone_surrogates(spark):
    nodes = [{"name": "a", "parameters": {"rules": '{"values": [{"id": "r\\ud800"}, {"id": "\\ud83d\\ude00"}]}'}}]
    frame = spark.createDataFrame([(1, nodes, '{"a": {"main": [[{"node": "a\\udc00"}]]}}')], "file_id long, nodes array<struct<name:string,parameters:map<string,string>>>, connections string")
    got = {(r["kind"], r["slot"], r["child"]) for r in flatten.flatten(frame).collect()}
    assert got == {("rule", 0, "r\ufffd"), ("rule", 1, "\U0001f600")}
