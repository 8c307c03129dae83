"""Long exact spans that several records share: seed by winnowed anchors, extend both ways.

With ``k + w - 1 = length``, every window of ``length`` characters holds ``w`` grams of ``k``
characters, and the one with the smallest hash (the rightmost of equals) depends on nothing
but the window. So two texts that share ``length`` characters have an anchor in common inside
them. Anchors that lie in more than one distinct text are joined back to their text, with
``length - k`` characters before and after: a shared window that holds the anchor can reach
no further, so whether a pair shares one is decided exactly from these neighbourhoods.

Copies of a whole text are represented by one of them until the end. No group is ever paired
out: within an anchor's group rows are put into classes by the window they have in common, and
a pair is written only at the first anchor of the run it shares. Crowded anchors, such as those
of boilerplate, form no groups: the digests of all windows that hold them are counted, which is
linear, and only windows that several texts have go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

LENGTH = 240
GRAM = 96
#: What the arrays of one anchor's group may take. A group is compared in one task; the windows around an
#: anchor with more occurrences are counted instead, which is as exact, takes more shuffle and no group.
GROUP_BYTES = 8_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_BLOCK = 1 << 18  # characters hashed at once


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    factors = np.full(_BLOCK + 512, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Running polynomial hashes modulo 2^64, along the last axis, of mixed code points."""
    terms = _mix(codes.astype(np.uint64) + _MULT) * _POWERS[: codes.shape[-1]]
    zero = np.zeros((*codes.shape[:-1], 1), np.uint64)
    return np.concatenate([zero, np.cumsum(terms, axis=-1, dtype=np.uint64)], axis=-1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum) over each run of ``width``; one entry per run that fits."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = best(out[:-step], out[step:])
        done += step
    return out


def anchors_of(codes: np.ndarray, ends: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of texts laid end to end; ``ends`` has each text's end."""
    n = len(codes)
    if n < k + w - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = _prefix_hashes(codes)
    grams = _mix((sums[k:] - sums[:-k]) * _INVERSES[: n - k + 1])
    # The low bits hold the place, counted backwards: of equal hashes the rightmost is smallest.
    low = np.uint64(_BLOCK * 2 - 1)
    keys = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    least = _slide(keys, w, np.minimum)
    first = np.arange(len(least))
    end_of = ends[np.searchsorted(ends, first, "right")]
    places = np.unique((low - (least[first + k + w - 1 <= end_of] & low)).astype(np.int64))
    return places, grams[places]


def _anchor_rows(k: int, w: int):
    def blocks(texts: list[str | None]):
        """Pieces of texts in blocks; long texts in pieces that overlap by a window less one."""
        parts, size = [], 0
        for i, text in enumerate(texts):
            if text is None or len(text) < k + w - 1:
                continue
            codes = code_points(text)
            step = _BLOCK - (k + w - 2)
            for at in range(0, max(1, len(codes) - (k + w - 2)), step):
                piece = codes[at : at + _BLOCK]
                if size + len(piece) > _BLOCK and parts:
                    yield parts
                    parts, size = [], 0
                parts.append((i, at, piece))
                size += len(piece)
        if parts:
            yield parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            before: tuple[int, int] = (-1, -1)
            for parts in blocks(batch.column(1).to_pylist()):
                ends = np.cumsum([len(p) for _, _, p in parts])
                places, grams = anchors_of(np.concatenate([p for _, _, p in parts]), ends, k, w)
                part = np.searchsorted(ends, places, "right")
                which = np.array([i for i, _, _ in parts])[part]
                pos = places - np.concatenate([[0], ends[:-1]])[part] + np.array([a for _, a, _ in parts])[part]
                again = (which[1:] == which[:-1]) & (pos[1:] == pos[:-1])  # from the overlap of two pieces
                keep = np.concatenate([[True], ~again]) if len(pos) else np.empty(0, bool)
                if len(pos) and (which[0], pos[0]) == before:
                    keep[0] = False
                gap = np.zeros(len(pos), np.int64)
                if len(pos):
                    gap[1:] = np.where(which[1:] == which[:-1], pos[1:] - pos[:-1], 0)
                    gap[0] = pos[0] - before[1] if which[0] == before[0] else 0
                    before = (int(which[-1]), int(pos[-1]))
                gap[(gap > w) | (gap < 0)] = 0  # 0: no anchor just before
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[keep].view(np.int64)), pa.array(ids[which[keep]], pa.int64()), pa.array(pos[keep] << 8 | gap[keep])],
                    names=["anchor", "doc", "at"],
                )

    return run


def _neighbourhoods(k: int, around: int):
    """(doc, text, [(anchor, at)]) to one row per anchor with its surroundings, and its group's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                for x in found:
                    pos, gap = x["at"] >> 8, x["at"] & 255
                    left, mid, right = text[max(0, pos - around) : pos], text[pos : pos + k], text[pos + k : pos + k + around]
                    rows.append((hash_text(mid) ^ x["anchor"], doc, pos, gap, left, right))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return run


def _windows(length: int, around: int):
    """(doc, text, [(anchor, at)]) to every window that holds one of the anchors: its digest, its
    start, and a hash of the window one place further left (of the record where there is none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[int, int], tuple[bytes, int]] = {}
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                starts = {p for x in found for p in range(max(0, (x["at"] >> 8) - around), min(x["at"] >> 8, len(text) - length) + 1)}
                digests = {p: _digest(text[p : p + length]) for p in starts | {p - 1 for p in starts if p}}
                for p in starts:
                    before = digests[p - 1] if p else _digest(f"^{doc}")
                    rows[doc, p] = digests[p], int.from_bytes(before[:8], "little", signed=True)
                if len(rows) > 50_000:
                    yield _window_batch(rows)
                    rows = {}
            if rows:
                yield _window_batch(rows)

    return run


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _window_batch(rows):
    docs, starts = zip(*rows)
    windows, before = zip(*rows.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(windows, pa.binary()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(before, pa.int64())],
        names=["window", "doc", "start", "before"],
    )


def hash_text(text: str) -> int:
    """A 64-bit hash that does not depend on the process."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["group", "doc", "pos", "gap", "left", "right"]
    wrap = [((g + (1 << 63)) % (1 << 64) - (1 << 63), *r) for g, *r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*wrap), kinds)], names=names)


def _pad(texts: list[str], width: int, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes (of reversed suffixes) of texts of at most ``width``, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    grid = np.zeros((len(texts), width), np.uint32)
    flat = code_points("".join(t[::-1] for t in texts) if reverse else "".join(texts))
    grid[np.arange(width) < size[:, None]] = flat
    return _prefix_hashes(grid), size


def _match(groups, docs, pos, gaps, lefts, rights, around, want_pairs):
    """Pairs (or covered stretches) of whole groups of neighbourhoods."""
    n = len(docs)
    lsum, lsize = _pad(lefts, around, True)
    rsum, rsize = _pad(rights, around, False)
    # The anchor before, if any, and what lies between: rows that agree in both shared a run there.
    prior = np.where((gaps > 0) & (gaps <= lsize), _mix(lsum[np.arange(n), np.minimum(gaps, lsize)] + gaps.astype(np.uint64)), np.uint64(0))
    low, high = np.full(n, around + 1), np.full(n, -1)
    out_a, out_b = [], []
    seed = _mix(groups.view(np.uint64))
    for o in range(around + 1):  # o characters before the anchor, around - o after it
        rows = np.flatnonzero((lsize >= o) & (rsize >= around - o))
        if len(rows) < 2:
            continue
        key = _mix(seed[rows] ^ _mix(lsum[rows, o] + np.uint64(o))) + _mix(rsum[rows, around - o] * _MULT)
        order = rows[np.argsort(key, kind="stable")]
        key = np.sort(key, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        starts, sizes = cuts[:-1], np.diff(cuts)

        def varied(x):  # of each class: whether x differs within it
            return np.minimum.reduceat(x[order], starts) != np.maximum.reduceat(x[order], starts)

        several = varied(docs)
        some = order[np.repeat(several, sizes)]
        low[some], high[some] = np.minimum(low[some], o), np.maximum(high[some], o)
        if not want_pairs or not several.any():
            continue
        # Written already: pairs that share the window one place further left, or the anchor before.
        longer = (rsize > around - o) & (o > 0)
        shift = np.where(longer, rsum[:, min(around, around - o + 1)] | np.uint64(1), np.uint64(0))
        done = (~varied(shift) & (shift[order[starts]] > 0)) | (~varied(prior) & (prior[order[starts]] > 0))
        for a, b in zip(starts[several & ~done], cuts[1:][several & ~done]):
            some = order[a:b]
            own, moved, before = docs[some], shift[some], prior[some]
            for i in range(len(some) - 1):
                fresh = (own[i + 1 :] != own[i]) & ~((moved[i] > 0) & (moved[i + 1 :] == moved[i]))
                other = own[i + 1 :][fresh & ~((before[i] > 0) & (before[i + 1 :] == before[i]))]
                if len(other):
                    out_a.append(np.minimum(other, own[i]))
                    out_b.append(np.maximum(other, own[i]))
    if want_pairs:
        return np.concatenate(out_a or [np.empty(0, np.int64)]), np.concatenate(out_b or [np.empty(0, np.int64)])
    hit = np.flatnonzero(high >= 0)
    return docs[hit], pos[hit] - high[hit], pos[hit] - low[hit]


def _grouped(k: int, around: int, want_pairs: bool):
    """Over partitions sorted by group: whole groups at a time, carried over batch borders."""

    def flush(rows):
        groups, docs, pos, gaps = (np.array(c, np.int64) for c in rows[:4])
        found = _match(groups, docs, pos, gaps, rows[4], rows[5], around, want_pairs)
        if want_pairs:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["doc_a", "doc_b"])
        doc, start, last = found
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(last + k + around)], names=["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(6)]
        for batch in batches:
            for have, column in zip(held, batch.columns):
                have += column.to_pylist()
            group = held[0]
            last = len(group)
            while last and group[last - 1] == group[-1]:
                last -= 1
            for at, end in _cuts(group, last, 4000):
                yield flush([c[at:end] for c in held])
            held = [c[last:] for c in held]
        if held[0]:
            for at, end in _cuts(held[0], len(held[0]), 4000):
                yield flush([c[at:end] for c in held])

    return run


def _cuts(group, end, size):
    """Stretches of about ``size`` rows that end where a group ends."""
    at = 0
    while at < end:
        to = min(at + size, end)
        while to < end and group[to] == group[to - 1]:
            to += 1
        yield at, to
        at = to


def text_classes(documents: DataFrame, length: int = LENGTH, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc, rep, n)`` of texts of at least ``length`` characters that occur more than once."""
    own = documents.where(F.char_length(text) >= length).select(
        F.col(id_col).cast("long").alias("doc"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("key")
    )
    groups = own.groupBy("key").agg(F.min("doc").alias("rep"), F.max("doc").alias("top"), F.count("*").alias("n"))
    return own.join(groups.where("top > rep"), "key").select("doc", "rep", "n").distinct()


class SharedSpans:
    """Shared spans of at least ``length`` characters among the texts of a table.

    Null texts and texts shorter than ``length`` share nothing. A row delivered twice counts as
    one record, as its id is the same; a span that occurs twice in one record only is not shared.
    Other columns of the table are not read.
    """

    def __init__(self, documents: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", id_col: str = "doc_id"):
        if not 1 <= gram <= length <= _BLOCK // 4 or length - gram > 254:
            raise ValueError("need gram <= length, and length - gram at most 254")
        self.length, self.gram, self.around = length, gram, length - gram
        # Per row a code point (4 bytes) and a running hash (8) for each character on both sides.
        self.most = max(1, GROUP_BYTES // (2 * 12 * (self.around + 1)))
        docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text")).where(F.char_length("text") >= length)
        self.classes = materialize(text_classes(docs, length, "text", "doc"), "span-classes")
        self.docs, self.others = docs, self.classes.where("doc != rep").select("doc")  # of each class one text takes part

    def _surroundings(self) -> tuple[DataFrame, DataFrame]:
        """Neighbourhoods of anchors that several texts have, by group; windows of the crowded ones."""
        w = self.around + 1
        anchors = self.docs.select("doc", "text").mapInArrow(_anchor_rows(self.gram, w), "anchor long, doc long, at long")
        # Copies go here and not before: where they are too many to be broadcast, anchors move instead of texts.
        anchors = materialize(anchors.join(self.others, "doc", "left_anti").select("anchor", "doc", "at"), "span-anchors")
        shared = anchors.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n"))
        shared = materialize(shared.where("least < most").select("anchor", (F.col("n") > self.most).alias("crowded")), "span-shared")

        def texts(which: str) -> DataFrame:
            seeds = anchors.join(shared.where(which).select("anchor"), "anchor")
            seeds = seeds.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at")).alias("found"))
            # Written, so that the planner moves the texts only if the seeds are many.
            return self.docs.join(materialize(seeds, "span-seeds"), "doc").select("doc", "text", "found")

        near = texts("not crowded").mapInArrow(
            _neighbourhoods(self.gram, self.around), "group long, doc long, pos long, gap long, `left` string, `right` string"
        )
        windows = texts("crowded").mapInArrow(_windows(self.length, self.around), "window binary, doc long, start long, before long")
        windows = materialize(windows.distinct(), "span-windows")
        counted = windows.groupBy("window").agg(
            F.min("doc").alias("least"), F.max("doc").alias("most"), (F.min("before") < F.max("before")).alias("begins")
        )
        windows = windows.join(counted.where("least < most").select("window", "begins"), "window")
        return near.repartition("group").sortWithinPartitions("group"), windows

    def pairs(self) -> DataFrame:
        """``(doc_a, doc_b)``, ``doc_a < doc_b``: every pair of records that share such a span."""
        near, windows = self._surroundings()
        pairs = near.mapInArrow(_grouped(self.gram, self.around, True), "doc_a long, doc_b long")
        # A pair that shares the window before as well is written there.
        begin = windows.where("begins").select("window", "doc", "before").distinct()
        one, two = begin.alias("one"), begin.alias("two")
        more = one.join(
            two, (F.col("one.window") == F.col("two.window")) & (F.col("one.doc") < F.col("two.doc")) & (F.col("one.before") != F.col("two.before"))
        )
        pairs = materialize(pairs.union(more.select("one.doc", "two.doc")).distinct(), "span-pairs")
        members = self.classes.select(F.col("rep"), F.col("doc").alias("member"))
        for side in ("doc_a", "doc_b"):
            pairs = pairs.join(members, F.col(side) == F.col("rep"), "left").withColumn(side, F.coalesce("member", side)).drop("rep", "member")
        pairs = pairs.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))
        one, two = members.alias("one"), members.alias("two")
        copies = one.join(two, (F.col("one.rep") == F.col("two.rep")) & (F.col("one.member") < F.col("two.member")))
        return pairs.union(copies.select(F.col("one.member"), F.col("two.member")))

    def shares(self, documents: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
        """``(doc_id, n_chars, n_shared, share)`` of every record; null and empty texts have share 0."""
        near, windows = self._surroundings()
        spans = near.mapInArrow(_grouped(self.gram, self.around, False), "doc long, start long, `end` long")
        spans = spans.union(windows.select("doc", "start", F.col("start") + self.length))
        spans = spans.groupBy("doc", "start").agg(F.max("end").alias("end"))
        merged = spans.groupBy("doc").applyInArrow(_covered, "doc long, n_shared long")
        whole = self.classes.select("doc", F.lit(True).alias("whole")).distinct()
        return (
            documents.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"))
            .distinct()
            .join(merged, "doc", "left")
            .join(whole, "doc", "left")
            .select(
                F.col("doc").alias(id_col),
                "n_chars",
                F.when(F.col("whole"), F.col("n_chars")).otherwise(F.coalesce("n_shared", F.lit(0))).alias("n_shared"),
            )
            .withColumn("share", F.when(F.col("n_chars") > 0, F.col("n_shared") / F.col("n_chars")).otherwise(0.0))
        )


def _covered(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("start").to_numpy())
    start, end = table.column("start").to_numpy()[order], table.column("end").to_numpy()[order]
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[0], reach[:-1]])
    total = int(np.maximum(0, end - np.maximum(start, new)).sum())
    return pa.table({"doc": table.column("doc").slice(0, 1), "n_shared": pa.array([total], pa.int64())})
