"""Shared spans against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from sparvane.llm import spans

LENGTH, GRAM = 30, 12


def texts(seed):
    rnd = random.Random(seed)
    word = lambda n, letters="abcdefghijklmnopq点🙂": "".join(rnd.choice(letters) for _ in range(n))
    passages = [word(n) for n in (29, 30, 31, 45, 90, 200)]
    out = []
    for k in range(120):
        parts = [word(rnd.randint(0, 60))]
        for _ in range(rnd.choice([0, 1, 2])):
            p = rnd.choice(passages)
            a = rnd.randint(0, max(0, len(p) - 20))
            parts += [p[a:] if rnd.random() < 0.5 else p, word(rnd.randint(0, 60))]
        out.append("".join(parts))
    out += ["x" * 200, "x" * 90, "ab" * 60, "ba" * 40, out[5], out[5], out[5], None, "", " ", passages[2] * 4, word(5000) + passages[5] + word(5000)]
    return list(enumerate(out)) + [(3, out[3])]


def brute(rows):
    where = defaultdict(set)
    for i, t in dict(rows).items():
        for k in range(len(t or "") - LENGTH + 1):
            where[t[k : k + LENGTH]].add((i, k))
    pairs, covered = set(), defaultdict(set)
    for found in where.values():
        ids = sorted({i for i, _ in found})
        pairs |= {(a, b) for a in ids for b in ids if a < b}
        if len(ids) > 1:
            for i, k in found:
                covered[i].update(range(k, k + LENGTH))
    return pairs, {i: len(c) for i, c in covered.items()}


@pytest.mark.parametrize("crowded", [spans.GROUP_BYTES, 3 * 24 * (LENGTH - GRAM + 1)])
def test_pairs_and_shares(spark, monkeypatch, crowded):
    monkeypatch.setattr(spans, "GROUP_BYTES", crowded)
    rows = texts(7)
    frame = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, doc int, `left` string").repartition(3)
    shared = spans.SharedSpans(frame, LENGTH, GRAM)
    pairs, covered = brute(rows)
    got = [tuple(r) for r in shared.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    shares = {r["doc_id"]: (r["n_chars"], r["n_shared"], r["share"]) for r in shared.shares(frame).collect()}
    for i, t in dict(rows).items():
        n = len(t or "")
        assert shares[i] == (n, covered.get(i, 0), covered.get(i, 0) / n if n else 0.0)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    shared = spans.SharedSpans(frame)
    assert shared.pairs().count() == 0 and shared.shares(frame).count() == 0
    with pytest.raises(ValueError):
        spans.SharedSpans(frame, 240, 300)


def test_long_text_in_pieces(monkeypatch):
    """Anchors do not depend on how a text is cut into blocks."""
    import pyarrow as pa

    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdef") for _ in range(40_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "short" * 30])], names=["doc", "text"])
    read = lambda: sorted(r for b in spans._anchor_rows(GRAM, 19)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns)))
    whole = read()
    monkeypatch.setattr(spans, "_BLOCK", 4096)
    assert read() == whole and len(whole) > 40_000 / 19
    assert np.diff([at >> 8 for _, d, at in sorted(whole, key=lambda r: r[2]) if d == 1]).max() <= 19
