"""API documents as records, code hooks, the command line, and the package's facade."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

import sparvane
from sparvane import cli
from sparvane.functions import text
from sparvane.operators import code, digest, vector
from sparvane.sources import api_docs

PAGE = """# API Documentation: Sync {x}

## Overview
Automated workflow. It contains 3 nodes.

## Workflow Metadata
- **Total Nodes**: 6
- **Complexity Level**: Moderate
- **Estimated Execution Time**: 5-30 seconds
- **Error Handling**: ✅ Implemented

## Trigger Information
### Trigger Types
- `base.webhook`
- `base.webhook`

### Webhook Endpoints
- **Path**: `customers/:id`
- **Method**: `['GET', 'DELETE']`
- **Webhook ID**: `580c`

- **Path**: `b`
- **Method**: `POST`
- **Webhook ID**: ``


## Node Types Used
- `base.webhook`
- `base.set`

## Integrations
- No external integrations detected

## Required Credentials
- `aApi`

## Environment Variables
- No environment variables required
"""


def test_api_docs(spark, tmp_path):
    (tmp_path / "1_api_docs.md").write_text(PAGE)
    (tmp_path / "2_api_docs.md").write_text("")
    (tmp_path / "other.md").write_text(PAGE)
    rows = {r["filename"]: r for r in api_docs.read_api_docs(spark, str(tmp_path)).collect()}
    one = rows["1_api_docs.md"]
    assert (one["title"], one["total_nodes"], one["complexity"], one["est_time"], one["error_handling"]) == ("Sync {x}", 6, "Moderate", "5-30 seconds", True)
    assert one["triggers"] == ["base.webhook"] * 2 and one["node_types"] == ["base.webhook", "base.set"]
    assert [tuple(w) for w in one["webhooks"]] == [("customers/:id", ["GET", "DELETE"], "580c"), ("b", ["POST"], "")]
    assert one["integrations"] == [] and one["credentials"] == ["aApi"] and one["env_vars"] == []
    assert set(rows) <= {"1_api_docs.md", "2_api_docs.md"}


def test_code_hooks(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v long")
    doubled = code.over_items(frame, lambda p: p.assign(v=p.v * 2), frame.schema)
    assert sorted(r["v"] for r in doubled.collect()) == [2, 4, 6]
    plus = code.per_item(lambda s: s + 1, "long")
    assert sorted(r[0] for r in frame.select(plus(F.col("v"))).collect()) == [2, 3, 4]
    total = code.per_group(frame, ["k"], lambda p: pd.DataFrame({"k": [p.k.iloc[0]], "n": [int(p.v.sum())]}), "k string, n long")
    assert sorted(tuple(r) for r in total.collect()) == [("a", 3), ("b", 3)]
    assert code.one_to_many(frame, "v", range, "long").count() == 6
    texts = spark.createDataFrame([("d", 2, "World!"), ("d", 1, "Hello"), ("d", 3, None)], "id string, pos int, t string")
    assert code.map_reduce_text(texts, ["id"], "pos", "t", lambda t: t[:3], "-".join).first()["summary"] == "Hel-Wor"
    watched, seen = code.observed(frame, "figures", n=F.count("*"))
    watched.collect()
    assert seen.get == {"n": 3}


def test_command_line(spark, tmp_path, capsys):
    source, catalog = tmp_path / "in", str(tmp_path / "catalog")
    source.mkdir()
    assert cli.main([str(source), catalog, "--stats"]) == 1
    write = lambda name, kind: (source / name).write_text(json.dumps({"name": name, "nodes": [{"type": kind}], "connections": {}}))
    write("a.json", "x.webhook")
    write("b.json", "x.manualTrigger")
    (source / "c.json").write_text("{")
    assert cli.index(spark, str(source), catalog) == {"processed": 2, "skipped": 0, "errors": 1, "total": 3}
    write("b.json", "x.cron")
    assert cli.index(spark, str(source), catalog) == {"processed": 1, "skipped": 1, "errors": 1, "total": 3}
    assert cli.index(spark, str(source), catalog, force=True)["processed"] == 2
    assert cli.main([str(source), catalog, "--stats"]) == 0
    assert "triggers: {'Scheduled': 1, 'Webhook': 1}" in capsys.readouterr().out


def test_small_functions(spark):
    one = spark.createDataFrame([({"sessionKey": "s", "b": "c"}, "- x\n2) y\n\nz", "1,5 h")], "p map<string,string>, t string, u string")
    row = one.select(text.replace_credentials(F.col("p"), ["sessionKey"]), text.parse_items(F.col("t")), text.chunk_words(F.col("t"), 2, 1)).first()
    assert row[0] == {"sessionKey": "{{ $credentials.sessionKey }}", "b": "c"} and row[1] == ["x", "y", "z"]
    assert row[2] == ["- x", "x 2)", "2) y", "y z"]
    near = spark.createDataFrame([(1, 5, 0.3), (1, 6, 0.9), (1, 7, 0.3)], "query_id int, id int, s double")
    assert [r["id"] for r in vector.rerank(near, 2, F.col("s")).orderBy("rank2").collect()] == [6, 5]
    failed = spark.createDataFrame([("b", "down")], "source string, error string")
    got = digest.run_summary(spark.createDataFrame([("a",), ("a",)], "source string"), failed).collect()
    assert sorted(map(tuple, got)) == [("a", 2, None), ("b", 0, "down")]


def test_facade():
    assert sparvane.operators.__name__ == "sparvane.operators" and "sources" in dir(sparvane)
    with pytest.raises(AttributeError):
        sparvane.nothing
