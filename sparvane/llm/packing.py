"""Filling containers of a fixed capacity with items measured in tokens.

The global histogram of lengths (at most ``capacity`` entries) says all that packing needs.
Dynamic programming over it chooses length buckets that minimise padding; token-budget batches
are formed inside each bucket, so many items to a container as its upper border allows. Left at
that, the buckets above half the capacity would leave their containers up to half empty, so what
room a batch leaves is filled from smaller buckets in the same way (``within=False``). The plan of
all this, made on bucket counts alone, tells how many containers take how many items of which
buckets. Each item then finds its container from its rank within its bucket, so no container is ever
gathered and no task sees more than a slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

BUCKETS = 160
#: Rows that one slice of a bucket is ranked in.
SLICE_ROWS = 200_000


def length_buckets(lengths: np.ndarray, counts: np.ndarray, capacity: int, buckets: int = BUCKETS) -> np.ndarray:
    """Upper borders of at most ``buckets`` buckets with the least padding, by dynamic programming.

    Padding is what items would take if each was as long as its bucket's upper border. That cost is Monge,
    so the best cut of a longer prefix is never before that of a shorter one: with ``m`` distinct lengths each
    round takes about ``m log m`` steps, and all lengths are borders to choose from.
    """
    borders, here = np.unique(np.minimum(np.asarray(lengths, np.int64), capacity), return_inverse=True)
    m = len(borders)
    if m <= buckets:
        return borders
    counts = np.asarray(counts, np.int64)
    n = np.concatenate([[0], np.cumsum(np.bincount(here, counts).astype(np.int64))])
    total = np.concatenate([[0], np.cumsum(np.bincount(here, counts * np.asarray(lengths, np.int64)).astype(np.int64))])
    up = np.concatenate([[0], borders])

    def cost(i, j):  # of one bucket with the lengths i..j-1; none with none
        return up[j] * (n[j] - n[i]) - (total[j] - total[i])

    best, came = cost(0, np.arange(m + 1)), []
    for _ in range(buckets - 1):
        cut, value = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
        step = 1 << m.bit_length()
        while step:
            j = np.arange(step, m + 1, 2 * step)  # between those that are known
            low, high = cut[j - step], j.copy()
            known = j + step <= m
            high[known] = np.minimum(high[known], cut[j[known] + step])
            size = high - low + 1
            starts = np.cumsum(size) - size
            i = np.arange(size.sum()) - np.repeat(starts - low, size)
            tried = best[i] + cost(i, np.repeat(j, size))
            if len(j):
                value[j] = np.minimum.reduceat(tried, starts)
                hit = np.flatnonzero(tried == np.repeat(value[j], size))
                cut[j] = i[hit[np.searchsorted(hit, starts)]]
            step //= 2
        came.append(cut.astype(np.int32))
        best = value
    chosen, at = [], m
    for cut in reversed(came):
        if at and cut[at] < at:
            chosen.append(borders[at - 1])
            at = int(cut[at])
    if at:
        chosen.append(borders[at - 1])
    return np.array(chosen[::-1], np.int64)


def container_plan(borders: np.ndarray, counts: np.ndarray, capacity: int, within: bool = False) -> list[tuple[int, int, int, int, int]]:
    """How containers are filled: ``(bucket, first rank, items each, first container, containers)``.

    Largest bucket first, as many of its items as fit; unless batches are to stay ``within`` one bucket,
    what room is left goes to the largest bucket that fits, so long as it lasts. All containers that look
    alike are planned at once: the plan grows with the number of buckets, not with that of items.
    """
    left, used = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    plan, container = [], 0
    while left.any():
        room, recipe, k = capacity, [], len(borders) - 1
        while k >= 0 and room > 0:
            k = min(k, int(np.searchsorted(borders, room, "right")) - 1)
            while k >= 0 and not left[k]:
                k -= 1
            if k < 0:
                break
            each = int(min(room // borders[k], left[k]))
            recipe.append((k, each))
            room -= each * int(borders[k])
            k = -1 if within else k - 1
        times = max(1, min(int(left[k] // each) for k, each in recipe))
        for k, each in recipe:
            plan.append((k, int(used[k]), each, container, times))
            used[k] += each * times
            left[k] -= each * times
        container += times
    return plan


def _bins(plan: np.ndarray):
    """(bucket, rank) to the container, by a search in the plan's rows, which are sorted by both."""

    def run(bucket: pa.Array, rank: pa.Array) -> pa.Array:
        bucket, rank = bucket.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        out = np.empty(len(bucket), np.int64)
        for b in np.unique(bucket):
            own, rows = bucket == b, plan[plan[:, 0] == b]
            _, first, each, container, _ = rows[np.searchsorted(rows[:, 1], rank[own], "right") - 1].T
            out[own] = container + (rank[own] - first) // each
        return pa.array(out)

    return F.arrow_udf(run, "long")


def pack(
    sized: DataFrame, capacity: int, id_col: str = "doc_id", size_col: str = "n_tokens", buckets: int = BUCKETS, within: bool = False
) -> DataFrame:
    """``(id, piece, start, n_tokens, bin_id)``: the containers of one capacity.

    Rows with a null or zero size are left out. An item larger than ``capacity`` is cut into
    pieces that fill containers of their own and a rest, which is packed with the others; no
    other item is split. Ids must be unique. An empty table gives no row.
    """
    items = sized.where(F.col(size_col) > 0).select(F.col(id_col).alias("id"), F.col(size_col).cast("long").alias("size"))
    last = ((F.col("size") - 1) / capacity).cast("long")
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("n", F.least(F.lit(capacity), F.col("size") - F.col("start")))
    pieces = pieces.select("id", "piece", "start", "n")
    histogram = pieces.groupBy("n").count().orderBy("n").collect()  # at most `capacity` rows
    if not histogram:
        return pieces.select(F.col("id").alias(id_col), "piece", "start", F.col("n").alias(size_col), F.lit(0).cast("long").alias("bin_id"))
    lengths, counts = np.array([r["n"] for r in histogram]), np.array([r["count"] for r in histogram])
    borders = length_buckets(lengths, counts, capacity, buckets)
    bucket_of = np.searchsorted(borders, lengths)
    held = np.bincount(bucket_of, counts, len(borders))
    # Rank within the bucket: rows are ranked in slices, and slices start where the one before ends.
    slices = max(1, int(-(-counts.sum() // SLICE_ROWS)))
    edges = F.array(*[F.lit(int(b)) for b in borders])
    ranked = pieces.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n"))))
    ranked = ranked.withColumn("slice", F.pmod(F.xxhash64("id", "piece"), F.lit(slices)).cast("int"))
    sizes = ranked.groupBy("bucket", "slice").count()
    w = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "slice", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("offset"))
    in_slice = Window.partitionBy("bucket", "slice").orderBy("id", "piece")
    ranked = ranked.withColumn("rank", F.row_number().over(in_slice) - 1).join(offsets, ["bucket", "slice"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("offset"))
    # The plan travels with the function that reads it: at most a few rows for each pair of buckets, whatever the data.
    plan = np.array(sorted(container_plan(borders, held, capacity, within)), np.int64)
    bin_id = _bins(plan)("bucket", "rank")
    return ranked.select(F.col("id").alias(id_col), "piece", "start", F.col("n").alias(size_col), bin_id.alias("bin_id"))


def pack_containers(sized: DataFrame, containers: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens") -> DataFrame:
    """``pack`` for every row of ``containers`` (``container``, ``capacity``; a handful, fixed).

    An id delivered twice is packed once. Capacities below 1 and null ones are left out.
    """
    sized = materialize(sized.select(id_col, size_col).dropDuplicates([id_col]), "packing-sizes")
    out = None
    for row in containers.where("capacity > 0").select("container", "capacity").distinct().collect():
        packed = pack(sized, row["capacity"], id_col, size_col)
        packed = packed.select(F.lit(row["container"]).alias("container"), F.lit(row["capacity"]).alias("capacity"), "*")
        out = packed if out is None else out.unionByName(packed)
    if out is None:
        raise ValueError("no container has a capacity above 0")
    return out
