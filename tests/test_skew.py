"""Heavy keys: results must be those of a plain aggregation, whatever the skew."""

import random
from collections import Counter, defaultdict

import pytest

from sparvane.operators import skew

SCHEMA = "k string, id long, flag boolean, m int, told string, slice int, n long"


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for k, rs in groups.items():
        ms = [r[3] for r in rs if r[3] is not None]
        out[k] = (len(rs), len({r[1] for r in rs if r[1] is not None}), sum(r[2] is True for r in rs), sum(ms) / len(ms) if ms else None)
    return out


def make(n, seed=0):
    rnd = random.Random(seed)
    keys = ["hot"] * 40 + [None] * 20 + ["", "Hot", "~", "=x"] + [f"k{i}" for i in range(200)]
    pick = lambda x: None if rnd.random() < 0.1 else x
    return [(rnd.choice(keys), pick(rnd.randrange(50)), pick(rnd.random() < 0.5), pick(rnd.randrange(9)), "x", 1, 2) for _ in range(n)]


@pytest.mark.parametrize("rows", [make(3000), [], [(None, None, None, None, "x", 1, 2)] * 5, [("a", 1, True, 2, "x", 1, 2)] * 7])
def test_per_key(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in skew.per_key(frame, "k", "id", "flag", "m").collect()}
    assert got == expected(rows)


def test_frequent_values(spark):
    rows = make(5000, 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for share in (0.001, 0.05, 0.12, 1.0):
        want = {k: n for k, n in Counter(r[0] for r in rows).items() if k is not None and n >= share * len(rows)}
        assert {r["key_value"]: r["n"] for r in skew.frequent_values(frame, "k", share).collect()} == want
    assert skew.frequent_values(frame.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        skew.heavy_keys(frame, "k", 0)


def test_exact_share_counts(spark):
    frame = spark.createDataFrame([("a",)] * 1 + [("b",)] * 19, "k string")
    assert {r["key_value"] for r in skew.frequent_values(frame, "k", 0.05).collect()} == {"a", "b"}
