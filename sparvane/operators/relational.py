"""Merging, comparing and routing item streams. Every operator is a function of frames; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

HOW = ("inner", "left", "right", "full_outer", "left_semi", "left_anti")


def merge_append(*inputs: DataFrame) -> DataFrame:
    """Rows of all inputs, columns aligned by name; columns an input lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


#: Ways to join that may be asked for; whether a side is broadcast is left to the planner, which knows its size.
HINTS = ("merge", "shuffle_hash")


def merge_by_key(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner", suffix: str = "_right", hint: str | None = None) -> DataFrame:
    """Equi-join on ``on``; columns of ``b`` that clash get ``suffix``. Null keys match nothing."""
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    if hint is not None:
        if hint not in HINTS:
            raise ValueError(f"hint must be one of {HINTS}")
        b = b.hint(hint)
    clash = {c: c + suffix for c in b.columns if c in a.columns and c not in on}
    return a.join(b.withColumnsRenamed(clash), on, how)


def _spare(df: DataFrame, *names: str) -> list[str]:
    """Column names for the time being that no column of ``df`` has, letter case aside."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """0-based positions in ``order``, without moving all rows to one task.

    Rows are range-partitioned, numbered within their partition and written to the shared folder; the
    partitions are counted from that table, so that every row is counted and numbered in the same
    partition. Rows that tie are told apart by where they were read, so ties spread over partitions too.
    A column that is called ``name`` already is replaced.
    """
    df = df.drop(name)
    row, part, within, start = _spare(df, "_row", "_part", "_in", "_start")
    keyed = df.withColumn(row, F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(*order, F.col(row)).sortWithinPartitions(*order, F.col(row)).drop(row)
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = materialize(ranged.withColumns({part: F.spark_partition_id(), within: here}), "positions")
    counts = numbered.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start))
    # As many rows as the session has shuffle partitions, whatever the data.
    return numbered.join(F.broadcast(starts), part).withColumn(name, F.col(start) + F.col(within)).drop(part, within, start)


def merge_by_position(a: DataFrame, b: DataFrame, order_a: list[Column], order_b: list[Column], how: str = "inner") -> DataFrame:
    """The i-th row of ``a`` beside the i-th of ``b``, each in its stated total order; adds ``position``."""
    return merge_by_key(with_position(a, order_a), with_position(b, order_b), ["position"], how)


def merge_all_combinations(a: DataFrame, small: DataFrame, condition: Column | None = None) -> DataFrame:
    """Every row of ``a`` with every row of ``small`` for which ``condition`` holds (a theta join)."""
    return a.crossJoin(small) if condition is None else a.join(small, condition)


def compare_datasets(a: DataFrame, b: DataFrame, on: list[str], fields: list[str] | None = None) -> DataFrame:
    """``on``, ``status`` and both sides' fields (``a_*``, ``b_*``): only_a, only_b, same or different.

    Fields are compared null-safe, and so are keys: a null key is a key like any other. Keys must be
    unique on each side, else their rows are combined.
    """
    fields = [c for c in a.columns if c in b.columns and c not in on] if fields is None else fields
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in [*on, *fields]], F.lit(True).alias("_a"))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in [*on, *fields]], F.lit(True).alias("_b"))
    joined = left.join(right, reduce(Column.__and__, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in on]), "full_outer")
    same = reduce(Column.__and__, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in fields], F.lit(True))
    status = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(same, "same").otherwise("different")
    keys = [F.when(F.col("_a"), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c) for c in on]
    return joined.select(*keys, status.alias("status"), *[f"{s}_{c}" for c in fields for s in "ab"])


def sync_plan(source: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    """What to do to ``target`` so that it equals ``source``: ``on``, ``action`` (insert, update, delete)."""
    compared = compare_datasets(source, target, on)
    action = F.when(F.col("status") == "only_a", "insert").when(F.col("status") == "only_b", "delete").when(F.col("status") == "different", "update")
    return compared.select(*on, action.alias("action")).where("action is not null")


def remove_duplicates(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order`` if given, else any of equal rows (keys must be all columns then)."""
    if order is None:
        return df.dropDuplicates(keys)
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def difference(a: DataFrame, b: DataFrame, keep_all: bool = False) -> DataFrame:
    return a.exceptAll(b) if keep_all else a.subtract(b)


def intersection(a: DataFrame, b: DataFrame, keep_all: bool = False) -> DataFrame:
    return a.intersectAll(b) if keep_all else a.intersect(b)


def prefer_existing(derived: DataFrame, chosen: DataFrame, on: list[str], column: str) -> DataFrame:
    """``derived`` with ``column`` replaced where ``chosen`` has a value for the key."""
    own = chosen.select(*on, F.col(column).alias("_chosen"))
    return derived.join(own, on, "left").withColumn(column, F.coalesce("_chosen", column)).drop("_chosen")


def range_join(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, width: int, on: list[str] | None = None) -> DataFrame:
    """Points inside ``[start, end)``, by buckets of ``width``: an equi-join, whatever the sizes.

    A range is repeated once per bucket it meets, so ``width`` should be near the usual length.
    """
    bucket = F.floor(F.col(point) / width)
    spread = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    joined = points.withColumn("_bucket", bucket).join(spread, [*(on or []), "_bucket"])
    return joined.where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_bucket")


#: Rows in a slice of an ordered table; what crosses from one slice to the next is carried over.
SLICE_ROWS = 200_000


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str]) -> DataFrame:
    """Each left row with the ``values`` of the last right row at or before its time; null keys match null keys.

    Both sides are put into one order and cut into slices of ``SLICE_ROWS``, so a key that most rows have fills
    many tasks. The last value of each key in a slice is carried to the key's next slices.
    """
    spare = _spare(left, "_v", "_side", "_p", "_slice", "_carried")
    v, side, place, piece, carried = spare
    kept = right.select(F.struct(*values)).schema[0].dataType
    nulls = [F.lit(None).cast(t).alias(c) for c, t in left.dtypes if c not in (*by, time)]
    a = left.select(*left.columns, F.lit(None).cast(kept).alias(v), F.lit(1).alias(side))
    b = right.select(*by, time, F.struct(*values).alias(v), F.lit(0).alias(side), *nulls)
    both = with_position(a.unionByName(b), [*map(F.col, by), F.col(time), F.col(side)], place)
    both = both.withColumn(piece, F.floor(F.col(place) / SLICE_ROWS))
    upto = Window.partitionBy(piece, *by).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    # A row per key and slice: as many as a key's rows over SLICE_ROWS, and one more.
    ends = both.where(F.col(v).isNotNull()).groupBy(piece, *by).agg(F.max_by(v, place).alias(carried))
    here = both.select(piece, *by).distinct().withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(by)}).withColumnRenamed(piece, "_to")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], F.lit(True))
    steps = here.join(ends, same & (F.col("_to") == F.col(piece)), "left").select("_to", *[f"_k{i}" for i in range(len(by))], carried)
    before = Window.partitionBy(*[f"_k{i}" for i in range(len(by))]).orderBy("_to").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn(carried, F.last(carried, ignorenulls=True).over(before)).where(F.col(carried).isNotNull())
    found = both.withColumn(v, F.last(v, ignorenulls=True).over(upto)).where(F.col(side) == 1)
    joined = found.join(steps, same & (F.col("_to") == F.col(piece)), "left")
    return joined.withColumn(v, F.coalesce(v, carried)).select(*left.columns, f"{v}.*")
