"""Packing: nothing lost or split without need, little room left, buckets of least padding."""

from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparvane.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_buckets_are_optimal(histogram, buckets):
    lengths, counts = np.array(sorted(histogram)), np.array([histogram[k] for k in sorted(histogram)])

    def padding(borders):
        up = np.array(borders)[np.searchsorted(borders, lengths)]
        return int(((up - lengths) * counts).sum())

    got = packing.length_buckets(lengths, counts, 40, buckets)
    top = int(lengths[-1])
    best = min(padding([*c, top]) for n in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1].tolist(), n))
    assert len(got) <= max(buckets, 1) and padding(got.tolist()) == best


def test_buckets_of_many_lengths():
    """As good as by trying every cut, with thousands of lengths of a heavy tail."""
    rnd = np.random.default_rng(2)
    lengths, counts = np.unique(np.minimum((rnd.pareto(0.7, 20000) * 30).astype(int) + 1, 4096), return_counts=True)
    borders = packing.length_buckets(lengths, counts, 4096, 20)
    assert len(lengths) > 1024 and len(borders) == 20 and borders[-1] == lengths[-1]
    n, total = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * lengths))
    i, j = np.triu_indices(len(n), 1)
    cost = np.full((len(n), len(n)), np.inf)
    cost[i, j] = lengths[j - 1] * (n[j] - n[i]) - (total[j] - total[i])
    best = cost[0].copy()
    for _ in range(19):
        best = np.minimum(best, (best[:, None] + cost).min(axis=0))
    assert int(((borders[np.searchsorted(borders, lengths)] - lengths) * counts).sum()) == best[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(1, 30)), min_size=1, max_size=12))
def test_plan_uses_every_item_once(items):
    histogram = dict(items)
    borders, counts = np.array(sorted(histogram)), np.array([histogram[k] for k in sorted(histogram)])
    room, used = {}, np.zeros(len(borders), int)
    for k, first, each, container, times in packing.container_plan(borders, counts, 100):
        assert first == used[k]
        used[k] += each * times
        for c in range(container, container + times):
            room[c] = room.get(c, 100) - each * borders[k]
    assert used.tolist() == counts.tolist() and min(room.values()) >= 0


def check(rows, sizes, capacity):
    bins = {}
    pieces = {}
    for r in rows:
        bins[r["bin_id"]] = bins.get(r["bin_id"], 0) + r["n_tokens"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"]))
    assert max(bins.values(), default=0) <= capacity
    assert set(pieces) == {k for k, n in sizes.items() if n}
    for k, parts in pieces.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == sizes[k] and len(parts) == -(-sizes[k] // capacity)
    return len(bins)


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 500)
    rnd = np.random.default_rng(5)
    sizes = {k: int(n) for k, n in enumerate(rnd.lognormal(4.2, 1.1, 3000))}
    sizes |= {3000: 512, 3001: 513, 3002: 1024, 3003: 0, 3004: None} | {k: 100 for k in range(4000, 6000)}
    frame = spark.createDataFrame([(k, n, "x") for k, n in sizes.items()], "doc_id long, n_tokens long, bucket string")
    containers = spark.createDataFrame([("short", 512), ("long", 4096), ("none", 0), (None, None)], "container string, capacity int")
    out = packing.pack_containers(frame.union(frame.where("doc_id < 50")), containers).collect()
    for name, capacity in (("short", 512), ("long", 4096)):
        n = check([r for r in out if r["container"] == name], sizes, capacity)
        assert n <= 1.03 * -(-sum(x or 0 for x in sizes.values()) // capacity) + 1
    assert packing.pack_containers(frame.limit(0), containers).count() == 0
    alone = packing.pack(frame.dropDuplicates(["doc_id"]), 512, within=True, buckets=30).collect()
    assert check(alone, sizes, 512) > n
    borders = packing.length_buckets(*np.unique([r["n_tokens"] for r in alone], return_counts=True), 512, 30)
    own = {}
    for r in alone:
        own.setdefault(r["bin_id"], set()).add(int(np.searchsorted(borders, r["n_tokens"])))
    assert {len(x) for x in own.values()} == {1}
    with pytest.raises(ValueError):
        packing.pack_containers(frame, containers.limit(0))
