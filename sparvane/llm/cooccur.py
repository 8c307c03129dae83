"""Items that appear together: pair counts by a heavy-light split, scored by lift.

Items that many records hold are heavy: a block of records becomes a bit matrix, one row per
heavy item, and a pair's count is the popcount of two rows' conjunction. All other items are
light: their pairs within a record are counted by hash, and pairs of a light and a heavy item
by probing the record's list of heavy ones. Every block and every record gives partial counts,
which are added up; no record list of an item is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

#: Most items that may be heavy; bounds the broadcast list and the bit matrix.
HEAVY_ITEMS = 1024
#: Share of the records from which an item can be heavy.
HEAVY_SHARE = 1 / 256
_BLOCK = 8192


def baskets(records: DataFrame, items) -> DataFrame:
    """``(items)``: the distinct non-null items of each record that has any list at all."""
    return records.where(F.size(items) > 0).select(F.array_compact(F.array_distinct(items)).alias("items"))


def _codes(column: pa.Array, heavy: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each item, and its place among the heavy ones (-1 for light items)."""
    row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return row, pc.index_in(column.flatten(), value_set=heavy).fill_null(-1).to_numpy(zero_copy_only=False)


def _split(items: list[str]):
    """Records with light items: those, and the numbers of their heavy ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = pa.array(items, pa.string())
        for batch in batches:
            column = batch.column(0)
            row, code = _codes(column, heavy)
            light = code < 0
            lists = []
            for keep, values in ((light, column.flatten().filter(pa.array(light))), (~light, pa.array(code[~light], pa.int32()))):
                ends = np.cumsum(np.bincount(row[keep], minlength=len(column)))
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values))
            some = pa.array(np.bincount(row[light], minlength=len(column)) > 0)
            yield pa.RecordBatch.from_arrays(lists, names=["light", "heavy"]).filter(some)

    return run


def _heavy_counts(items: list[str]):
    n_heavy = len(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, total = pa.array(items, pa.string()), np.zeros((n_heavy, n_heavy), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                column = batch.column(0).slice(at, _BLOCK)
                n = len(column)
                row, code = _codes(column, heavy)
                bits = np.zeros((n_heavy, -(-n // 64) * 64), bool)
                bits[code[code >= 0], row[code >= 0]] = True
                words = np.packbits(bits, axis=1).view(np.uint64)
                for i in np.flatnonzero(words.any(axis=1)):
                    total[i, i:] += np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64)
        a, b = np.nonzero(total)
        off = a < b
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[off], pa.int32()), pa.array(b[off], pa.int32()), pa.array(total[a[off], b[off]])], names=["a", "b", "n_ab"]
        )

    return run


def pair_counts(records: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Of ``baskets``: ``(type_a, type_b, n_ab)``, ``(item, n)``, and the number of records.

    Pairs that no record has are not listed. Records of one item count towards the number only.
    """
    records = materialize(records, "baskets")
    total = records.count()
    counts = materialize(records.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")), "item-counts")
    heavy = [r["item"] for r in counts.where(F.col("n") >= HEAVY_SHARE * total).orderBy(F.desc("n"), "item").limit(HEAVY_ITEMS).collect()]
    spark = records.sparkSession
    names = spark.createDataFrame([(k, x) for k, x in enumerate(heavy)], "k int, item string")
    split = records.mapInArrow(_split(heavy), "light array<string>, heavy array<int>")
    parts = []
    if heavy:
        dense = records.mapInArrow(_heavy_counts(heavy), "a int, b int, n_ab long")
        dense = dense.groupBy("a", "b").agg(F.sum("n_ab").alias("n_ab"))
        one, two = names.select(F.col("k").alias("a"), F.col("item").alias("x")), names.select(F.col("k").alias("b"), F.col("item").alias("y"))
        parts.append(dense.join(F.broadcast(one), "a").join(F.broadcast(two), "b").select("x", "y", "n_ab"))
        probes = split.select(F.explode("light").alias("x"), "heavy").select("x", F.explode("heavy").alias("k"))
        probes = probes.groupBy("x", "k").agg(F.count("*").alias("n_ab"))
        parts.append(probes.join(F.broadcast(names), "k").select("x", F.col("item").alias("y"), "n_ab"))
    rare = split.where(F.size("light") > 1).select("light", F.explode("light").alias("x"))
    rare = rare.select("x", F.explode(F.filter("light", lambda y: y > F.col("x"))).alias("y"))
    parts.append(rare.groupBy("x", "y").agg(F.count("*").alias("n_ab")))
    pairs = parts[0]
    for part in parts[1:]:
        pairs = pairs.union(part)
    return pairs.select(F.least("x", "y").alias("type_a"), F.greatest("x", "y").alias("type_b"), "n_ab"), counts, total


def scored_pairs(records: DataFrame) -> DataFrame:
    """``(type_a, type_b, n_ab, n_a, n_b, n_records, lift)``; lift is 1 where a pair is as frequent as chance."""
    pairs, counts, total = pair_counts(records)
    a = counts.select(F.col("item").alias("type_a"), F.col("n").alias("n_a"))
    b = counts.select(F.col("item").alias("type_b"), F.col("n").alias("n_b"))
    out = pairs.join(a, "type_a").join(b, "type_b").withColumn("n_records", F.lit(total).cast("long"))
    lift = F.col("n_ab").cast("double") * F.col("n_records") / (F.col("n_a").cast("double") * F.col("n_b"))
    return out.select("type_a", "type_b", "n_ab", "n_a", "n_b", "n_records", lift.alias("lift"))


def node_type_baskets(files: DataFrame) -> DataFrame:
    return baskets(files, F.transform("nodes", lambda n: n["type"]))
