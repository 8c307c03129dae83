"""Per-key results where a few keys hold most rows.

A Misra-Gries sketch per task and column names every key that may hold a given share of the rows,
for all columns in one scan; their exact counts follow in one more, against that short list. Heavy keys
are told apart by a broadcast join with the list and aggregated in salted slices first, the others by an
ordinary shuffle; the two results are united.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

#: Keys a sketch holds per heavy key it must find.
SLACK = 8


def _told(key: Column) -> Column:
    """A key that is never null: null is a key of its own, apart from all texts."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("~"))


class _MisraGries:
    def __init__(self, capacity: int):
        self.capacity, self.held, self.lost = capacity, {}, 0

    def add(self, column: pa.Array) -> None:
        held = self.held
        for x in pc.value_counts(column).to_pylist():
            held[x["values"]] = held.get(x["values"], 0) + x["counts"]
        if len(held) > self.capacity:
            # Take from all what the first key beyond the capacity has: its rows are the error.
            cut = sorted(held.values(), reverse=True)[self.capacity]
            self.held = {k: n - cut for k, n in held.items() if n > cut}
            self.lost += cut


def _sketch(capacity: int):
    """Told keys, a column each, to ``(column, key, n, lost)``; the row without a key has the rows and the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches: list[_MisraGries] = []
        total = 0
        for batch in batches:
            total += batch.num_rows
            sketches = sketches or [_MisraGries(capacity) for _ in batch.columns]
            for sketch, column in zip(sketches, batch.columns):
                sketch.add(column)
        for k, sketch in enumerate(sketches):
            keys, counts = [*sketch.held, None], [*sketch.held.values(), total]
            lost = [0] * len(sketch.held) + [sketch.lost]
            columns = [pa.array([k] * len(keys), pa.int32()), pa.array(keys, pa.string()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["column", "key", "n", "lost"])

    return run


def heavy_keys_of(df: DataFrame, columns: list[str], share: float = 0.05) -> tuple[list[list[str]], int]:
    """Per column the keys (as told apart by ``_told``) that may hold ``share`` of the rows; and the number of rows.

    Every key that does is among them; at most ``SLACK / share`` others are. Empty tables give none.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    capacity = max(16, int(SLACK / share))
    told = df.select(*[_told(F.col(c)).alias(f"key{k}") for k, c in enumerate(columns)])
    rows = told.mapInArrow(_sketch(capacity), "column int, key string, n long, lost long")
    merged = materialize(rows.groupBy("column", "key").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")), "heavy-keys")
    whole = {r["column"]: r for r in merged.where("key is null").collect()}  # a row per column
    out: list[list[str]] = [[] for _ in columns]
    if not whole:
        return out, 0
    # At most 1 / (share - lost / total) keys of a column reach its bound; lost is at most a 1 / capacity of total.
    heavy = F.lit(False)
    for k, r in whole.items():
        heavy = heavy | ((F.col("column") == k) & (F.col("n") >= share * r["n"] - r["lost"]))
    for r in merged.where(F.col("key").isNotNull() & heavy).collect():
        out[r["column"]].append(r["key"])
    return out, whole[0]["n"]


def heavy_keys(df: DataFrame, key: str, share: float = 0.05) -> tuple[list[str], int]:
    """``heavy_keys_of`` one column."""
    (keys,), total = heavy_keys_of(df, [key], share)
    return keys, total


def frequent_values_of(df: DataFrame, columns: list[str], share: float = 0.05) -> DataFrame:
    """``(field, key_value, n, total)`` of the non-null values of each column that hold ``share`` of all rows or more, exactly.

    Values come out as text. Two scans, whatever the number of columns.
    """
    keys, total = heavy_keys_of(df, columns, share)
    heavy = [(c, k) for c, some in zip(columns, keys) for k in some]
    heavy = F.broadcast(df.sparkSession.createDataFrame(heavy, "field string, told string"))  # bounded by columns and share
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("key_value"), _told(F.col(c)).alias("told")) for c in columns])
    rows = df.select(F.explode(cells).alias("x")).select("x.*").where(F.col("key_value").isNotNull())
    counted = rows.join(heavy, ["field", "told"]).groupBy("field", "key_value").agg(F.count("*").alias("n"))
    return counted.withColumn("total", F.lit(total).cast("long")).where(F.col("n") >= F.lit(share) * F.col("total") - 1e-9)


def frequent_values(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """``(key_value, n, total)``: ``frequent_values_of`` one column."""
    return frequent_values_of(df, [key], share).drop("field")


def per_key(
    df: DataFrame, key: str, id_col: str, flag: str, measure: str, share: float = 0.05, slices: int = 32, heavy: list[str] | None = None
) -> DataFrame:
    """``(key_value, n_rows, n_ids, n_flagged, avg_measure)`` of each value of ``key``, null included.

    ``n_ids`` counts distinct non-null ids, ``n_flagged`` rows where ``flag`` is true; the average
    leaves nulls out and is null where all are. Empty tables give no row. ``heavy`` are the keys of
    ``heavy_keys``, if they are known; which keys are among them changes the plan, not the result.
    """
    keys = heavy_keys(df, key, share)[0] if heavy is None else heavy
    heavy = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in keys], "told string"))
    rows = df.select(
        _told(F.col(key)).alias("told"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(flag), F.lit(False)).cast("long").alias("flagged"),
        F.col(measure).alias("measure"),
    )
    sums = (
        F.count("*").alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.sum("flagged").alias("n_flagged"),
        F.sum("measure").alias("total"),
        F.count("measure").alias("n_measured"),
    )
    # An id lies in one slice of its key only, so the slices' distinct counts add up.
    sliced = rows.join(heavy, "told").groupBy("told", F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice")).agg(*sums)
    of_heavy = sliced.groupBy("told").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_ids", "n_flagged", "total", "n_measured")])
    of_light = rows.join(heavy, "told", "left_anti").groupBy("told").agg(*sums)
    both = of_heavy.unionByName(of_light)
    value = F.when(F.col("told") != "~", F.expr("substring(told, 2)"))
    return both.select(
        value.alias("key_value"),
        "n_rows",
        "n_ids",
        "n_flagged",
        F.when(F.col("n_measured") > 0, F.col("total") / F.col("n_measured")).alias("avg_measure"),
    )
