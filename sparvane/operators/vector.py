"""Vector search and what follows from it. Vectors are ``ARRAY<FLOAT>`` of one length; others are left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

#: Bytes of vectors that make a block, of queries and of rows to search.
QUERY_BYTES, ROW_BYTES = 2_000_000, 8_000_000
#: Best rows a task holds over all query blocks before it gives them out.
_HELD = 4_000_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is null, empty or all zeros."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the rows that have ``dims`` numbers and are not all zeros, and those rows."""
    keep = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dims)
    flat = column.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    norm = np.sqrt((flat * flat).sum(axis=1))
    some = (norm > 0) & np.isfinite(norm)
    return flat[some] / norm[some, None], keep[some]


def _packed(rows: DataFrame, dims: int, size: int, label: str) -> DataFrame:
    """``(id, vector)`` rows to ``(number, ids, matrix)``: blocks of unit vectors as they lie; vectors without direction are left out."""
    most = max(1, size // (8 * max(dims, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block(some):
            ids, matrix = np.concatenate([x for x, _ in some]), np.concatenate([y for _, y in some])
            columns = [pa.array([int(ids[0])]), pa.array([ids], pa.list_(pa.int64())), pa.array([matrix.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["number", "ids", "matrix"])

        for batch in batches:
            matrix, keep = _matrix(batch.column(1), dims)
            ids = batch.column(0).to_numpy(zero_copy_only=False)[keep]
            for at in range(0, len(ids), most):
                held.append((ids[at : at + most], matrix[at : at + most]))
                if sum(len(x) for x, _ in held) >= most:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    return rows.mapInArrow(run, f"{label} long, {label}_ids array<long>, {label}_matrix binary")


def _search(dims: int, k: int, step: int = 1024):
    """Pairs of a block of rows and a block of queries to the best ``k`` rows of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def given():
            for queries, best, who in held.values():
                own, fine = np.repeat(queries, best.shape[1]), np.isfinite(best.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(own[fine]), pa.array(who.ravel()[fine]), pa.array(best.ravel()[fine])], names=["query_id", "id", "score"])
            held.clear()

        for batch in batches:
            for number, query_ids, queries, ids, rows in zip(*(batch.column(c).to_pylist() for c in ("q", "q_ids", "q_matrix", "r_ids", "r_matrix"))):
                query_ids, ids = np.array(query_ids), np.array(ids)
                queries, rows = (np.frombuffer(x, np.float64).reshape(-1, dims) for x in (queries, rows))
                if number not in held:
                    held[number] = query_ids, np.empty((len(query_ids), 0)), np.empty((len(query_ids), 0), np.int64)
                _, best, who = held[number]
                found, names = [], []
                for at in range(0, len(query_ids), step):
                    scores = queries[at : at + step] @ rows.T
                    scores[query_ids[at : at + step, None] == ids] = -np.inf  # not with itself
                    scores = np.concatenate([best[at : at + step], scores], axis=1)
                    near = np.concatenate([who[at : at + step], np.broadcast_to(ids, (len(scores), len(ids)))], axis=1)
                    # By falling score, then rising id: the same in every partitioning.
                    order = np.lexsort((near, -np.round(scores, 12)), axis=1)[:, :k]
                    found.append(np.take_along_axis(scores, order, 1))
                    names.append(np.take_along_axis(near, order, 1))
                held[number] = query_ids, np.concatenate(found), np.concatenate(names)
                if sum(x.size for _, x, _ in held.values()) > _HELD:
                    yield from given()
        yield from given()

    return run


def _dims(rows: DataFrame) -> int:
    return rows.agg(F.max(F.size("v"))).first()[0] or 0


def top_k(base: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, id, score, rank)``: the ``k`` rows of ``base`` nearest each query by cosine, exactly.

    A stated query set against all rows, in blocks: every block of queries meets every block of rows, a
    task keeps its best ``k`` per query, and those are merged. Nothing passes through the driver, and query
    blocks are broadcast only if the planner finds their table small. A query is not its own neighbour. Ties
    go to the smaller id.
    """
    wanted = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).where(F.size("v") > 0)
    dims = _dims(wanted)
    rows = _packed(base.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")), dims, ROW_BYTES, "r")
    blocks = materialize(_packed(wanted, dims, QUERY_BYTES, "q"), "query-blocks")
    pairs = rows.drop("r").crossJoin(blocks)
    found = pairs.mapInArrow(_search(dims, k), "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def centroid(df: DataFrame, by: list[str], vector: str = "embedding") -> DataFrame:
    """``(by, pos, mean)``: the element-wise mean, one row per dimension."""
    return df.select(*by, F.posexplode(vector).alias("pos", "x")).groupBy(*by, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroid_vectors(df: DataFrame, by: list[str], vector: str = "embedding") -> DataFrame:
    """``(by, centroid)`` as arrays."""
    parts = centroid(df, by, vector).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("_p"))
    return parts.select(*by, F.transform("_p", lambda p: p["mean"]).alias("centroid"))


def knn_classify(base: DataFrame, queries: DataFrame, k: int, label: str = "label", id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, predicted, votes)``: the label most of the ``k`` nearest have; ties go to the smaller."""
    near = top_k(base, queries, k, id_col, vector).join(base.select(F.col(id_col).alias("id"), label), "id")
    votes = near.groupBy("query_id", label).agg(F.count("*").alias("votes"))
    first = Window.partitionBy("query_id").orderBy(F.desc("votes"), label)
    return votes.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("query_id", F.col(label).alias("predicted"), "votes")


def centroid_distance(df: DataFrame, by: str, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, distance)``: the Euclidean distance of each row to the nearest centroid of ``by``; null for a null vector.

    Centroids are a written table of blocks, as many as there are groups; every row meets every block.
    """
    centers = centroid_vectors(df, [by], vector).select(F.col("centroid").alias("v"))
    size = max(1, QUERY_BYTES // (8 * max(_dims(df.select(F.col(vector).alias("v"))), 1)))
    blocks = centers.withColumn("_b", F.floor(F.rand(7) * F.ceil(F.lit(1.0) * centers.count() / size)))
    blocks = materialize(blocks.groupBy("_b").agg(F.collect_list("v").alias("_c")), "centroid-blocks")

    def gap(c):
        return F.sqrt(F.aggregate(F.zip_with(F.col(vector), c, lambda x, y: F.pow(x.cast("double") - y, 2)), F.lit(0.0), lambda s, x: s + x))

    near = df.crossJoin(blocks.select("_c")).select(id_col, F.array_min(F.transform("_c", gap)).alias("distance"))
    return near.groupBy(id_col).agg(F.min("distance").alias("distance"))


def embed_hashed(text: Column, dims: int = 64) -> Column:
    """A stand-in for a model's embedding: signed hashed counts of tokens, scaled to length 1."""
    from .search import tokens

    hashed = F.transform(tokens(text), lambda t: F.xxhash64(t))
    def at(k):
        own = F.filter(hashed, lambda h: F.pmod(h, F.lit(dims)) == k)
        return F.aggregate(own, F.lit(0.0), lambda s, h: s + F.when(F.shiftright(h, 40) % 2 == 0, 1.0).otherwise(-1.0))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), at)
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(raw, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)).cast("float"))


def rerank(candidates: DataFrame, k: int, score: Column, by: str = "query_id", id_col: str = "id") -> DataFrame:
    """The best ``k`` candidates per query by a second score, ties to the smaller id."""
    order = Window.partitionBy(by).orderBy(F.desc_nulls_last("score2"), id_col)
    scored = candidates.withColumn("score2", score)
    return scored.withColumn("rank2", F.row_number().over(order)).where(F.col("rank2") <= k)
