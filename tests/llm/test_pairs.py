"""Near-duplicates and co-occurrence against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparvane.llm import cooccur, neardup

WORDS = re.compile(r"[^\W_]+")


def shingles(text, kind):
    words = WORDS.findall((text or "").lower())
    if kind[1]:
        joined = " ".join(words)
        return {joined[k : k + kind[0]] for k in range(len(joined) - kind[0] + 1)} if len(joined) >= kind[2] else set()
    return {tuple(words[k : k + kind[0]]) for k in range(len(words) - kind[0] + 1)}


def brute(rows, kind, threshold=0.7):
    sets = {i: s for i, t in rows if (s := shingles(t, kind))}
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) * 10 >= threshold * 10 * len(sets[a] | sets[b]) - 1e-9}


def variants(seed, n):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    rows = []
    for _ in range(n):
        base = [word() for _ in range(rnd.randint(12, 60))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(len(own))] = word()
            rows.append((len(rows), rnd.choice([" ", "  ", "-"]).join(own)))
    copy = "the same text of nine words comes back here often"
    rows += [(len(rows) + k, copy.upper() if k % 2 else copy) for k in range(6)]
    return rows + [(9000, None), (9001, ""), (9002, "  "), (9003, "one two"), (9004, "one two"), (9005, "x " * 20000), (9006, "x " * 20001)] + rows[:3]


def test_near_duplicates(spark):
    rows = variants(3, 60)
    for kind in ((3, False), (3, True, 20)):
        frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc long, text string, id int")
        near = neardup.NearDuplicates([("f", frame.select("doc", "text"), kind)])
        got = [tuple(r)[1:] for r in near.pairs().collect()]
        want = brute(dict(rows).items(), kind)
        assert len(got) == len(set(got)) and set(got) <= want
        assert len(set(got)) >= 0.99 * len(want)
        groups = {r["id"]: r["group_id"] for r in near.groups().collect()}
        assert all(groups[a] == groups[b] for a, b in got) and set(groups) == {x for p in got for x in p}
        assert all(g <= i for i, g in groups.items())
    empty = neardup.NearDuplicates([("f", frame.select("doc", "text").limit(0), (3, False))])
    assert empty.pairs().count() == 0 and empty.groups().count() == 0


def batches_of(rows, step, names, kinds):
    parts = [rows[k : k + step] for k in range(0, len(rows), step)]
    return iter([pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*p), kinds)], names=names) for p in parts])


def test_shared_bands():
    rnd = random.Random(2)
    rows = sorted((rnd.randrange(60), rnd.randrange(40)) for _ in range(90))
    times = Counter(b for b, _ in set(rows))
    for step in (1, 2, 7, 200):
        out = neardup._shared(batches_of(rows, step, ["band", "id"], [pa.int64()] * 2))
        got = [e for x in out for e in zip(*(c.to_pylist() for c in x.columns))]
        assert sorted(got) == sorted({r for r in rows if times[r[0]] > 1})


def test_bucket_edges(monkeypatch):
    """All pairs of a bucket of up to FULL members, stars and marks of a larger one, whatever the batches."""
    monkeypatch.setattr(neardup, "FULL", 20)
    sizes = {5: 6, 7: 20, 8: 21, 9: 75, 10: 2, 11: 90, 12: 3}
    rows = [(b, 1000 * b + k, 5, b"\x0f" * 64) for b, m in sizes.items() for k in range(m)]
    for step in (1, 7, 30, 2000):
        out = neardup._bucket_edges(0.7, 512)(batches_of(rows, step, ["band", "id", "n", "sketch"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()]))
        got = [e for x in out for e in zip(*(c.to_pylist() for c in x.columns))]
        for b, m in sizes.items():
            own, ids = [e for e in got if e[0] // 1000 == b], [1000 * b + k for k in range(m)]
            crowd = {(ids[0], i) for i in ids} | {(i, i) for i in ids}
            assert set(own) == (crowd if m > 20 else set(combinations(ids, 2)))


def test_sketches_leave_out_no_alike_pair():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        size, bits = int(rnd.integers(1, 400)), 256
        pool = rnd.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
        a, b = pool[: size + int(rnd.integers(0, size))], pool[int(rnd.integers(0, max(1, size // 3))) : size + int(rnd.integers(0, size))]
        words = []
        for x in (a, b):
            marks = np.zeros(bits, bool)
            marks[(x % np.uint64(bits)).astype(int)] = True
            words.append(np.packbits(marks).view(np.uint64)[None])
        both = len(np.intersect1d(a, b))
        if both >= 0.7 * (len(a) + len(b) - both):
            assert neardup._plausible(np.array([len(a)]), np.array([len(b)]), *words, 0.7)[0]


def test_crowded_buckets(spark, monkeypatch):
    """Names of one template share buckets in hundreds; those that are alike are few. Some buckets are hot."""
    monkeypatch.setattr(neardup, "FULL", 64)
    rnd = random.Random(8)
    rows = [(k, "weekly sales report for the " + "".join(rnd.choice("abc") for _ in range(12))) for k in rnd.sample(range(9000), 1200)]
    kind = (3, True, 20)
    frame = spark.createDataFrame(rows, "id long, text string")
    want = brute(rows, kind)
    least = {i: i for p in want for i in p}
    for _ in range(50):
        for a, b in want:
            least[a] = least[b] = min(least[a], least[b])
    for share in (0.005, 2.0):  # with hot buckets, and without
        monkeypatch.setattr(neardup, "HOT_SHARE", share)
        near = neardup.NearDuplicates([("f", frame, kind)])
        assert near.parts[0][5].count() > 500
        got = [tuple(r)[1:] for r in near.pairs().collect()]
        assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.999 * len(want)
        assert {r["id"]: r["group_id"] for r in near.groups().collect()} == least


def test_crowded_buckets_move_only_plausible_pairs(spark, monkeypatch):
    """Names of one template share rare runs with many others by chance; what is gathered follows the pairs that are alike."""
    monkeypatch.setattr(neardup, "FULL", 64)
    rnd = random.Random(8)
    rows = [(k, "weekly sales report for the " + "".join(rnd.choice("abc") for _ in range(12))) for k in range(1200)]
    near = neardup.NearDuplicates([("f", spark.createDataFrame(rows, "id long, text string"), (3, True, 20))])
    ((field, kind, _, reps, edges, crowded, _),) = near.parts
    everyone = crowded.select("id", F.col("id").alias("label"))
    gathered = near._crowd(reps, crowded, edges.limit(0), kind, everyone)
    ids = {r["id"] for r in crowded.collect()}
    want = brute([r for r in rows if r[0] in ids], kind)
    got = {tuple(r) for r in gathered.collect()}
    assert want <= got and len(got) <= 2 * len(want)


def test_signatures_estimate():
    rnd = np.random.default_rng(1)
    for share in (0.5, 0.8):
        for size in (20, 2000):
            agree = []
            for _ in range(30):
                pool = rnd.integers(0, 1 << 63, size * 2, dtype=np.uint64)
                both = int(size * 2 * share / (1 + share))
                a, b = pool[:size], np.concatenate([pool[:both], pool[size : 2 * size - both]])
                grid = neardup.signatures(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 200)
                agree.append((grid[0] == grid[1]).mean())
            true = both / (2 * size - both)
            assert abs(np.mean(agree) - true) < 0.06


def test_pair_counts(spark, monkeypatch):
    rnd = random.Random(4)
    items = [f"hot{k}" for k in range(6)] * 8 + [f"rare{k}" for k in range(30)] + [None]
    rows = [(k, [rnd.choice(items) for _ in range(rnd.randint(0, 7))]) for k in range(2500)] + [(9000, None), (9001, []), (9002, [None])]
    monkeypatch.setattr(cooccur, "HEAVY_SHARE", 0.05)
    monkeypatch.setattr(cooccur, "_BLOCK", 300)
    frame = spark.createDataFrame([(k, x, "c") for k, x in rows], "id long, items array<string>, light string").repartition(3)
    got = {(r["type_a"], r["type_b"]): r for r in cooccur.scored_pairs(cooccur.baskets(frame, frame["items"])).collect()}
    sets = [sorted({i for i in x if i is not None}) for _, x in rows if x]
    single, double = Counter(i for s in sets for i in s), Counter(p for s in sets for p in combinations(s, 2))
    assert {p: r["n_ab"] for p, r in got.items()} == double
    for (a, b), r in got.items():
        assert (r["n_a"], r["n_b"], r["n_records"]) == (single[a], single[b], len(sets))
    assert cooccur.scored_pairs(cooccur.baskets(frame.limit(0), frame["items"])).count() == 0
