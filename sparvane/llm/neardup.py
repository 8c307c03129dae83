"""Near-duplicates by one-permutation hashing.

One hash of each shingle serves all bins of a signature: its high part picks the bin, the
smallest rest is the bin's value. Empty bins take the value of another bin, chosen by a hash
of the bin and the attempt until a full one is met (optimal densification), so signatures of
small sets agree as often as their sets do. Bands of a signature are buckets.

Records are signed once, with a sketch: a bitmap of the shingles' hashes, from which follows the
most that two sets can have in common. A bucket of up to ``FULL`` members gives every pair that its
sketches allow. A crowded one gives star edges from its smallest member, and its members are joined
exactly by the rarest shingles of their sets (prefix filter), which leaves out no alike pair. A bucket
that holds a share of all records is told by counts made while signing and never moved to one task.
Edges are checked exactly against the sets.

Records of equal words are one class; only its smallest id is banded and compared.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import discard, free_shuffles, materialize

THRESHOLD = 0.7
BANDS, ROWS = 44, 5
#: Buckets of so many members or fewer give every pair that sketches allow.
FULL = 1024
#: A bucket that holds this share of all records is hot: its members never meet in one task.
HOT_SHARE = 0.005
#: Records signed at once, and how many of them make a bucket worth counting.
_CHUNK, _OFTEN = 1024, 8
_WORDS = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(codes: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` successive codes within its record, and the record of each."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = codes[:n].copy()
    for k in range(1, width):
        out = _mix(out * _ODD + np.uint64(k)) ^ codes[k : n + k]
    ends = np.cumsum(size)
    first = np.arange(n)
    owner = np.searchsorted(ends, first, "right")
    inside = first + width <= ends[owner]
    return _mix(out[inside]), owner[inside]


class Shingles:
    """Turns texts into sets of hashed runs; the two kinds of this project's data are below."""

    def __init__(self, width: int, characters: bool, least: int = 0):
        self.width, self.characters, self.least = width, characters, least
        self.known: dict[str, int] = {}

    def runs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every run, and its record; records in order, runs as they come."""
        split = [_WORDS.findall(t.lower()) if t else [] for t in texts]
        if self.characters:
            joined = [" ".join(w) for w in split]
            joined = [t if len(t) >= self.least else "" for t in joined]
            codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            size = np.fromiter(map(len, joined), np.int64, len(joined))
        else:
            words = list(chain.from_iterable(split))
            if len(self.known) > 300_000:
                self.known.clear()
            for w in set(words).difference(self.known):
                self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
            size = np.fromiter(map(len, split), np.int64, len(split))
        return _runs(_mix(codes + _ODD), size, self.width)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The set of hashes of each text, sorted."""
        hashes, owner = self.runs(texts)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def signatures(hashes: np.ndarray, owner: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation signatures of ``n`` sets with optimal densification; rows of empty sets are all ones."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * bins, none, np.uint64)
    where = ((hashes >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
    np.minimum.at(out, owner * bins + where, _mix(hashes))
    out = out.reshape(n, bins)
    some = (out != none).any(axis=1)
    row, at = np.nonzero((out == none) & some[:, None])
    full = out.copy()
    todo, attempt = np.arange(len(row)), 1
    while len(todo):
        asked = (at[todo].astype(np.uint64) << np.uint64(20)) + np.uint64(attempt * int(_ODD) % (1 << 64))
        probe = (_mix(asked) % np.uint64(bins)).astype(np.int64)
        value = out[row[todo], probe]
        hit = value != none
        full[row[todo[hit]], at[todo[hit]]] = value[hit]
        todo, attempt = todo[~hit], attempt + 1
    return full


def _bits(kind: tuple) -> int:
    return 256 if kind[1] else 512  # runs of characters are taken of short texts


def _signed(kind: tuple, field: str, bands: int, rows: int, bits: int):
    """(id, text) to (id, size and sketch of its set, band keys); texts without a run give none.

    The last row of a task has no id: it has the buckets that many records of one chunk fell into, with
    their counts. At most 1,000 are kept; what is left out holds less than ``HOT_SHARE`` of the task.
    """
    seed = np.uint64(xxhash.xxh64_intdigest(field))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = Shingles(*kind), Counter()
        names = ["id", "n", "sketch", "bands", "counts"]
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                hashes, owner = shingles.runs(part.column(1).to_pylist())
                some, owner = np.unique(owner, return_inverse=True)
                n = len(some)
                if not n:
                    continue
                grid = signatures(hashes, owner, n, bands * rows)
                keys = np.broadcast_to(_mix(np.arange(bands, dtype=np.uint64) + seed), (n, bands))
                for r in range(rows):
                    keys = _mix(keys * _ODD + grid[:, r::rows])
                keys = (keys >> np.uint64(16)).view(np.int64)  # 48 bits: shorter to move; what they confuse is only compared in vain
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
                marks = np.zeros((n, bits), bool)
                marks[owner, (hashes % np.uint64(bits)).astype(np.int64)] = True
                sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bits // 8), n, [None, pa.py_buffer(np.packbits(marks, axis=1).tobytes())])
                value, times = np.unique(keys, return_counts=True)
                often.update(dict(zip(value[times >= _OFTEN].tolist(), times[times >= _OFTEN].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(some)).cast(pa.int64()), pa.array(np.bincount(owner[first], minlength=n).astype(np.int32)),
                        sketch.cast(pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel())),
                        pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    names=names,
                )
        bands_of, counts = zip(*often.most_common(1000)) if often else ((), ())
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, None, None, bands_of, counts), kinds)], names=names)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band and id: those of bands that several ids have, each once."""
    held = None  # the last row so far, and whether it was given out
    for batch in batches:
        band, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(band):
            continue
        out = np.zeros(len(band) + 1, bool)
        if held is None:
            held = (int(band[0]) - 1, 0, True)
        band, ids = np.concatenate([[held[0]], band]), np.concatenate([[held[1]], ids])
        fresh = np.concatenate([[True], (band[1:] != band[:-1]) | (ids[1:] != ids[:-1])])  # else a row delivered twice
        band, ids, out = band[fresh], ids[fresh], out[fresh]
        alike = band[1:] == band[:-1]
        out[1:] |= alike
        out[:-1] |= alike
        last = (int(band[-1]), int(ids[-1]), bool(out[-1]) or (len(band) == 1 and held[2]))
        if held[2]:
            out[0] = False
        held = last
        yield pa.RecordBatch.from_arrays([pa.array(band[out]), pa.array(ids[out])], names=["band", "id"])


def _plausible(n_a, n_b, sketch_a, sketch_b, threshold: float) -> np.ndarray:
    """Whether two sets of these sizes and sketches can be as similar as asked for; never false where they are.

    Each mark of one sketch that the other lacks stands for at least one member that the other set lacks.
    """
    only_a = np.bitwise_count(sketch_a & ~sketch_b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(sketch_b & ~sketch_a).sum(axis=1, dtype=np.int64)
    both = np.minimum(n_a - only_a, n_b - only_b)
    return both >= threshold * (n_a + n_b - both) - 1e-9


def _bucket_edges(threshold: float, bits: int):
    """Rows (band, id, n, sketch) sorted by band and id to edges.

    A bucket of up to ``FULL`` members gives all its plausible pairs. Of a larger one, each member gives an
    edge from the first one and, to mark it as crowded, an edge to itself. At most ``FULL`` rows of a bucket
    are held over from one batch to the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, crowd = None, None  # rows of a bucket that may go on; band and first member of a crowded one
        for batch in chain(batches, [None]):
            if batch is not None:
                band, ids, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
                marks = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(-1, bits // 64)
                rows = (band, ids, n.astype(np.int64), marks)
                rows = rows if held is None else tuple(np.concatenate(x) for x in zip(held, rows))
            elif held is not None:
                rows = held
            else:
                break
            band, ids, n, marks = rows
            if not len(band):
                continue
            a, b = [], []
            if crowd is not None:
                more = int(np.searchsorted(band, crowd[0], "right"))
                a += [np.full(more, crowd[1]), ids[:more]]
                b += [ids[:more], ids[:more]]
                band, ids, n, marks = band[more:], ids[more:], n[more:], marks[more:]
                if len(band):
                    crowd = None
            cuts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]])) if len(band) else np.zeros(1, np.int64)
            size = np.diff(cuts)
            for at in np.flatnonzero(size > FULL):
                own = ids[cuts[at] : cuts[at + 1]]
                a += [np.full(len(own) - 1, own[0]), own]
                b += [own[1:], own]
            end = len(band)
            if batch is not None and len(size):  # the last bucket may go on
                end = int(cuts[-2])
                if size[-1] > FULL:
                    crowd = (band[end], ids[end])
                    held = None
                else:
                    held = (band[end:], ids[end:], n[end:], marks[end:])
                size = size[:-1]
            else:
                held = None
            left = np.repeat(np.where(size > FULL, 0, size), size) - (np.arange(end) - np.repeat(cuts[: len(size)], size))
            for lag in range(1, min(FULL, int(left.max(initial=0)))):
                one = np.flatnonzero(left > lag)
                two = one + lag
                fine = _plausible(n[one], n[two], marks[one], marks[two], threshold) & (ids[one] != ids[two])
                a.append(ids[one[fine]])
                b.append(ids[two[fine]])
            none = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["id_a", "id_b"])
            if batch is None:
                break

    return run


def _tokens(kind: tuple):
    """(id, text) to (token, id, size), one row per member of the text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(*kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = shingles.sets(part.column(1).to_pylist())
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sets).view(np.int64)), pa.array(ids, pa.int64()), pa.array(np.repeat(size, size))], names=["token", "id", "n"]
                )

    return run


def _alike(kind: tuple, threshold: float):
    """(id_a, id_b, text_a, text_b) to the pairs whose sets are as similar as asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(*kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = part.column(2).to_pylist(), part.column(3).to_pylist()
                texts = list({*a, *b})
                sets = dict(zip(texts, shingles.sets(texts)))
                keep = []
                for x, y in zip(a, b):
                    x, y = sets[x], sets[y]
                    if min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
                        keep.append(False)
                        continue
                    merged = np.concatenate([x, y])
                    merged.sort()
                    both = int((merged[1:] == merged[:-1]).sum())
                    keep.append(both >= threshold * (len(merged) - both) - 1e-9 and both > 0)
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _words_key(text) -> F.Column:
    """A 128-bit digest of a text's lower-cased words."""
    return F.unhex(F.md5(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))))


class NearDuplicates:
    """Groups and pairs of records whose shingle sets have a Jaccard similarity of ``threshold`` or more.

    ``sources`` are ``(field, id and text frame, (width, characters?, least length))``. Null and
    empty texts, and texts without a run, are in no pair. A row delivered twice counts once.
    """

    def __init__(self, sources: list[tuple[str, DataFrame, tuple]], threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS):
        self.threshold = threshold

        def part(source):
            field, frame, kind = source
            id_col, text = frame.columns[:2]
            frame = frame.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
            return F.lit(field).alias("field"), kind, *self._stars(field, frame, kind, bands, rows)

        with ThreadPoolExecutor(max(1, len(sources))) as pool:  # sources don't wait for each other's last tasks
            self.parts = list(pool.map(part, sources))

    def _stars(self, field, frame, kind, bands, rows):
        """Classes of equal words, the texts, the candidate edges, the members of crowded buckets, and the edges that hold."""
        keyed = materialize(frame.select("id", _words_key(F.col("text")).alias("key")), f"keys-{field}").where("key is not null")
        several = keyed.groupBy("key").agg(F.min("id").alias("rep"), F.max("id").alias("most")).where("most > rep").select("key", "rep")
        classes = materialize(keyed.join(several, "key").select("id", "rep").distinct(), f"copies-{field}")
        others = classes.where("id != rep").select("id")
        bits = _bits(kind)
        schema = "id long, n int, sketch binary, bands array<long>, counts array<int>"
        # Where copies are too many to be broadcast, what is shorter moves: short texts, or what long ones are signed with.
        reps = frame.join(others, "id", "left_anti") if kind[1] else frame
        signed = materialize(reps.mapInArrow(_signed(kind, field, bands, rows, bits), schema), f"signed-{field}")
        # A class with no run at all has no similarity, not even to itself.
        classes = materialize(classes.join(signed.select(F.col("id").alias("rep")).distinct(), "rep", "left_semi"), f"classes-{field}")
        edges, crowded = self._candidates(field, signed, None if kind[1] else others, bits)
        first = materialize(self._checked(edges, frame, kind), f"alike-{field}")
        return classes, frame, edges, crowded, first

    def _candidates(self, field, signed, others, bits):
        """``(id_a, id_b)`` from the buckets, and the members of crowded ones with their sketches, without the ``others``.

        Sketches come as numbers, ``word0`` and on, and ``slack``: how many members of the set have no mark of their own.
        """
        records = signed.where("id is not null")
        least = max(FULL, int(HOT_SHARE * records.count()))
        records = records if others is None else records.join(others, "id", "left_anti")
        by_band = records.select("id", F.explode("bands").alias("band")).select("band", "id")
        counted = signed.where("id is null").select(F.explode(F.arrays_zip("bands", "counts")).alias("x"))
        counted = counted.groupBy(F.col("x.bands").alias("band")).agg(F.sum("x.counts").alias("times"))
        hot = [r["band"] for r in counted.where(F.col("times") >= least).collect()]  # at most BANDS / HOT_SHARE of them
        known = F.broadcast(signed.sparkSession.createDataFrame([(x,) for x in hot], "band long"))
        if hot and others is not None:  # copies were counted too
            exact = by_band.join(known, "band").groupBy("band").agg(F.count("*").alias("times"))
            hot = [r["band"] for r in exact.where(F.col("times") >= least).collect()]
            known = F.broadcast(signed.sparkSession.createDataFrame([(x,) for x in hot], "band long"))
        members = by_band.join(known, "band", "left_anti") if hot else by_band
        shared = members.repartition("band").sortWithinPartitions("band", "id").mapInArrow(_shared, "band long, id long")
        sketches = records.select("id", "n", "sketch").dropDuplicates(["id"])
        met = materialize(shared, f"met-{field}")
        free_shuffles(signed.sparkSession)  # all bands have moved
        stars = met.join(sketches, "id").select("band", "id", "n", "sketch").repartition("band").sortWithinPartitions("band", "id").mapInArrow(_bucket_edges(self.threshold, bits), "id_a long, id_b long")
        if hot:
            own = by_band.join(known, "band")
            hubs = F.broadcast(own.groupBy("band").agg(F.min("id").alias("hub")))  # a row per hot bucket
            ends = [F.struct(F.col(c).alias("id_a"), F.col("id").alias("id_b")) for c in ("hub", "id")]
            stars = stars.union(own.join(hubs, "band").select(F.explode(F.array(*ends)).alias("e")).select("e.*"))
        stars = materialize(stars.distinct(), f"stars-{field}")
        crowded = stars.where("id_a = id_b").select(F.col("id_a").alias("id"))
        if not crowded.isEmpty():
            words = [F.conv(F.hex(F.substring("sketch", 8 * k + 1, 8)), 16, -10).cast("long").alias(f"word{k}") for k in range(bits // 64)]
            crowded = sketches.join(crowded, "id", "left_semi").select("id", (F.col("n") - reduce(Column.__add__, map(F.bit_count, words))).alias("slack"), *words)
            crowded = materialize(crowded, f"crowded-{field}")
        for done in (met, signed):
            discard(done)
        free_shuffles(stars.sparkSession)
        return stars.where("id_a != id_b"), crowded

    @property
    def classes(self) -> DataFrame:
        """``(field, id, rep)`` of records whose words another record has too."""
        return reduce(DataFrame.union, [classes.select(field, "id", "rep") for field, _, classes, *_ in self.parts])

    @property
    def star_links(self) -> DataFrame:
        """``(field, id_a, id_b)``: the edges that hold, of crowded buckets the star edges alone."""
        return reduce(DataFrame.union, [links.select(part, "id_a", "id_b") for part, *_, links in self.parts])

    def _crowd(self, reps: DataFrame, crowded: DataFrame, edges: DataFrame, kind: tuple, labels: DataFrame) -> DataFrame:
        """``(id_a, id_b)``: what can be alike between members of crowded buckets of different labels, but for ``edges``.

        Tokens are ordered from the rarest on. Two sets that are alike share one among the first
        ``n - threshold * n + 1`` of each, and from the first that they share on, enough are left in both.
        Most that meet so are unlike, so their sketches are compared where they meet: only plausible pairs move.
        """
        t = self.threshold
        sets = reps.join(crowded, "id", "left_semi").dropDuplicates(["id"]).select("id", "text").mapInArrow(_tokens(kind), "token long, id long, n long")
        sets = materialize(sets, "crowd-sets")
        often = sets.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
        shared = sets.join(often, "token")
        own = Window.partitionBy("id")
        place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("times", "token"))  # tokens of one set alone come first
        heads = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1)
        heads = heads.select("token", "id", "n", "place").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        words = [f"word{k}" for k in range(_bits(kind) // 64)]
        mixed = heads.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
        heads = materialize(heads.join(mixed, "token", "left_semi").join(crowded, "id"), "crowd-heads")
        free_shuffles(heads.sparkSession)
        a, b = (heads.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "place", "label", "slack", *words)]) for x in "ab")
        left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
        enough = (F.col("n_a") + F.col("n_b")) * (t / (1 + t)) - 1e-6
        near = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * t - 1e-6
        marks = reduce(Column.__add__, [F.bit_count(F.col(f"{w}_a").bitwiseAND(F.col(f"{w}_b"))) for w in words])
        plausible = F.least("slack_a", "slack_b") + marks >= enough
        found = a.join(b, "token").where((F.col("id_a") < F.col("id_b")) & (F.col("label_a") != F.col("label_b")) & near & (left >= enough) & plausible)
        found = materialize(found.select("id_a", "id_b").distinct().join(edges, ["id_a", "id_b"], "left_anti"), "crowd-edges")
        for done in (sets, heads):
            discard(done)
        return found

    def _of_crowds(self, labels: DataFrame | None = None) -> list[tuple[DataFrame, DataFrame] | None]:
        """Per part the edges within crowded buckets that no star gave, and those of them that hold; None where no bucket is crowded."""
        out = []
        for field, kind, _, reps, edges, crowded, _ in self.parts:
            if crowded.isEmpty():
                out.append(None)
                continue
            own = labels.where(F.col("field") == field).select("id", "label") if labels is not None else crowded.select("id", F.col("id").alias("label"))
            more = self._crowd(reps, crowded, edges, kind, own)
            out.append((more, materialize(self._checked(more, reps, kind), "crowd-links")))
        return out

    def links(self) -> DataFrame:
        """``(field, id_a, id_b)`` between classes: all alike records that share a bucket."""
        out = []
        for (field, *_, first), crowd in zip(self.parts, self._of_crowds()):
            out.append((first if crowd is None else first.union(crowd[1])).select(field, "id_a", "id_b"))
        return reduce(DataFrame.union, out)

    def _checked(self, edges: DataFrame, texts: DataFrame, kind: tuple) -> DataFrame:
        """The edges whose sets are as similar as asked for, by exact comparison."""
        ids = materialize(edges.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct(), "edge-ends")
        some = materialize(texts.join(ids, "id", "left_semi").dropDuplicates(["id"]), "edge-texts")
        joined = edges.join(some.toDF("id_a", "text_a"), "id_a").join(some.toDF("id_b", "text_b"), "id_b")
        return joined.select("id_a", "id_b", "text_a", "text_b").mapInArrow(_alike(kind, self.threshold), "id_a long, id_b long")

    def pairs(self) -> DataFrame:
        """``(field, id_a, id_b)`` of all records, copies within a class and between classes included."""
        members = self.classes.select("field", "rep", F.col("id").alias("member"))
        out = self.links()
        for side in ("id_a", "id_b"):
            own = members.withColumnRenamed("rep", side)
            out = out.join(own, ["field", side], "left").withColumn(side, F.coalesce("member", side)).drop("member")
        out = out.select("field", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
        one, two = members.alias("one"), members.alias("two")
        same = one.join(
            two,
            (F.col("one.field") == F.col("two.field"))
            & (F.col("one.rep") == F.col("two.rep"))
            & (F.col("one.member") < F.col("two.member")),
        )
        return out.union(same.select(F.col("one.field"), F.col("one.member"), F.col("two.member")))

    def groups(self, rounds: int = 30) -> DataFrame:
        """``(field, id, group_id)`` of each record in a group: connected components of all links that share a bucket.

        Within crowded buckets, only members whose star links have not connected them yet are compared.
        """
        labels = self._labels(self.star_links, rounds)
        crowds = [found[1].select(part[0], "id_a", "id_b") for part, found in zip(self.parts, self._of_crowds(labels)) if found is not None]
        if any(not links.isEmpty() for links in crowds):
            labels = self._labels(reduce(DataFrame.union, crowds, self.star_links), rounds)
        rep = labels.select("field", F.col("id").alias("rep"), F.col("label"))
        whole = self.classes.join(rep, ["field", "rep"], "left").select("field", "id", F.coalesce("label", "rep").alias("group_id"))
        alone = labels.join(self.classes, ["field", "id"], "left_anti").select("field", "id", F.col("label").alias("group_id"))
        return whole.union(alone)

    def _labels(self, links: DataFrame, rounds: int) -> DataFrame:
        """``(field, id, label)``: the least id of each component of the links.

        Each round takes the least label among neighbours and then that label's own label, so
        paths halve; it ends when nothing changes.
        """
        ends = links.union(links.select("field", "id_b", "id_a")).toDF("field", "id", "other")
        labels = materialize(ends.groupBy("field", "id").agg(F.least(F.min("id"), F.min("other")).alias("label")), "labels")
        for _ in range(rounds):
            near = ends.join(labels.withColumnsRenamed({"id": "other"}), ["field", "other"]).select("field", "id", "label")
            least = near.union(labels).groupBy("field", "id").agg(F.min("label").alias("label"))
            of_label = labels.select("field", F.col("id").alias("label"), F.col("label").alias("further"))
            new = materialize(
                least.join(of_label, ["field", "label"], "left").select("field", "id", F.least("label", "further").alias("label")), "labels"
            )
            changed = new.join(labels.withColumnRenamed("label", "was"), ["field", "id"]).where("label < was").limit(1).count()
            labels = new
            if not changed:
                return labels
        raise RuntimeError(f"groups have not settled after {rounds} rounds")


def file_texts(files: DataFrame) -> DataFrame:
    """``(file_id, text)``: node by node the name, the type, then keys and values in ascending order of key."""

    def node(n):
        entries = F.array_sort(F.map_entries(n["parameters"]), lambda x, y: F.when(x["key"] < y["key"], -1).otherwise(1))
        told = F.transform(entries, lambda e: F.concat_ws(" ", e["key"], e["value"]))
        return F.concat_ws(" ", n["name"], n["type"], F.array_join(told, " "))

    return files.where(F.size("nodes") > 0).select("file_id", F.array_join(F.transform("nodes", node), " ").alias("text"))


def workflow_sources(files: DataFrame, rows: DataFrame) -> list[tuple[str, DataFrame, tuple]]:
    return [
        ("nodes", file_texts(files), (3, False)),
        ("name", rows.where(F.col("name").isNotNull()).select("wf_id", F.col("name").alias("text")), (3, True, 20)),
    ]
