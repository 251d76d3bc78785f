"""Exact top-k search by inner product: a Voronoi kNN join.

Queries and data are grouped by their nearest pivot. Summaries of the groups (count, radius, the
smallest distances) bound the scores that a query of one group can reach with a vector of another:
with pivots p and q, radius r of the queries and distance d of the vector,

    p.q - r|q| - d|p| - r d  <=  score  <=  p.q + r|q| + d|p| + r d.

The lower bounds of the vectors nearest to their pivots give each query group a score that its k-th
best cannot miss; a vector is sent to a query group only if its upper bound reaches that score.
Groups are solved in blocks, and the best of a query's blocks are merged. A block of vectors lies in
one of several slots, whose number grows with the data, and meets its query groups there: the
queries are sent to every slot, so that a group is not one task's work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pieces
from tidemark.session import stored

#: Pivots, and rows in a block of queries or of data.
PIVOTS, BLOCK = 32, 2048
#: Blocks of data in a slot, if that does not send more queries than vectors.
SLOT_BLOCKS = 16


def quantized(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` for each component as a double; null if the vector or a component is
    null or not finite."""
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == width).all():
        return values.reshape(-1, width)
    out[np.repeat(np.arange(len(size)), size), np.concatenate([np.arange(n) for n in size] or [np.zeros(0, np.int64)])] = values
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles as long as every partial sum fits, else in integers. Sums
    that might not fit 64 bits are an error."""
    largest = [max(-int(x.min()), int(x.max())) if x.size else 0 for x in (a, b)]
    bound = largest[0] * largest[1] * a.shape[1]
    if bound >= 2**63:
        raise ValueError("inner products of these vectors may not fit 64 bits")
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _packed(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    small = vectors.astype(np.int16)
    kind = small if (small == vectors).all() else vectors
    return bytes([kind.itemsize]) + ids.astype("<i8").tobytes() + kind.tobytes()


def _unpacked(body: bytes, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(body, "<i8", rows, offset=1)
    vectors = np.frombuffer(body, "<i2" if body[0] == 2 else "<i8", rows * width, offset=1 + 8 * rows)
    return ids, vectors.reshape(rows, width).astype(np.int64)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    kept = order[rank < k]
    return query[kept], ids[kept], scores[kept]


def exact_top_k(queries: DataFrame, data: DataFrame, id_column: str, vector: str, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` rows of ``data`` with
    another id that have the largest inner product (ties: the smaller id), all if there are fewer.

    ``vector`` holds whole numbers (see ``quantized``); rows where it is null take no part. Vectors
    of different lengths are compared as if filled up with zeros. Ids name rows: a row whose id is
    null takes no part, and rows that share an id are one candidate each. The largest components of
    both sides times each other and the length must stay below 2**63, so that scores are exact longs;
    other vectors are an error.
    """
    spark = data.sparkSession
    kind = lambda df: df.where(F.col(vector).isNotNull() & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<long>").alias("v"))
    points = kind(data)
    # Pivots: at most a fixed number of different vectors, the same in every run.
    drawn = points.orderBy(F.xxhash64("id", "v"), "id").limit(pivots).select("v").collect()
    chosen = [list(v) for v in dict.fromkeys(tuple(r.v) for r in drawn)]
    width = points.agg(F.max(F.size("v"))).first()[0] or 0
    if not chosen or not width:
        pairs = "query_id long, rank int, vec_id long, score long"
        if not chosen:
            return spark.createDataFrame([], pairs)
        chosen, width = chosen[:1], max(width, 1)
    centers = np.zeros((len(chosen), width))
    for i, v in enumerate(chosen):
        centers[i, : len(v)] = v

    def placed(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), width).astype(np.float64)
                square = (x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1)
                cell = square.argmin(1)
                far = np.sqrt(((x - centers[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(far)], names=["id", "v", "cell", "far"])

        return rows.mapInArrow(run, "id long, v array<long>, cell int, far double")

    located, asked = stored(placed(points), "cells"), stored(placed(kind(queries)), "queries")
    reach = {r.cell: r.far for r in asked.groupBy("cell").agg(F.max("far").alias("far")).collect()}
    nearest = Window.partitionBy("cell").orderBy("far", "id")
    # One more than k, as the query itself may be among them.
    near = located.select("cell", "far", "id").withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("cell", "far").collect()
    n_points, n_asked = located.count(), asked.count()
    slots = max(1, min(pieces(n_points, SLOT_BLOCKS * block), len(chosen) * n_points // max(1, n_asked)))
    needed = _bounds(centers, reach, np.array([r.cell for r in near], int), np.array([r.far for r in near]), k)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of vectors for each query group that may need them."""
        for batch in batches:
            ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            cell, far = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for group, least in needed.items():
                own = np.flatnonzero(far >= least[cell])
                parts = [own[i : i + block] for i in range(0, len(own), block)]
                slot = [zlib.crc32(ids[p].tobytes()) % slots for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group] * len(parts), pa.int32()),
                        pa.array(slot, pa.int32()),
                        pa.array([len(p) for p in parts], pa.int32()),
                        pa.array([_packed(ids[p], v[p]) for p in parts], pa.binary()),
                    ],
                    names=["group", "slot", "rows", "body"],
                )

    def asked_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, v, cell = batch.column(0).to_numpy(), _matrix(batch.column(1), width), batch.column(2).to_numpy()
            for group in np.unique(cell):
                own = np.flatnonzero(cell == group)
                for i in range(0, len(own), block):
                    p = own[i : i + block]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group], pa.int32()), pa.array([len(p)], pa.int32()), pa.array([_packed(ids[p], v[p])], pa.binary())], names=["group", "q_rows", "q_body"]
                    )

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, body, m, q_body in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                ids, v = _unpacked(body, n, width)
                q_ids, q = _unpacked(q_body, m, width)
                for i in range(0, m, 256):
                    scores = _product(q[i : i + 256], v)
                    found.append(_top(q_ids[i : i + 256], ids, scores, k))
            if found:
                best = _best(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in best], names=["query_id", "vec_id", "score"])

    blocks = located.mapInArrow(dealt, "group int, slot int, rows int, body binary")
    # Queries of a cell are gathered for full blocks; a frequent cell by several tasks.
    gathered = asked.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(pieces(n_asked, 8 * block))))
    asking = gathered.mapInArrow(asked_in_blocks, "group int, q_rows int, q_body binary")
    asking = asking.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    local = blocks.join(asking, ["group", "slot"]).select("rows", "body", "q_rows", "q_body").mapInArrow(solved, "query_id long, vec_id long, score long")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _top(q_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's scores those that can be among its k best: all from the k-th largest on."""
    own = q_ids[:, None] == ids[None, :]
    lowest = np.iinfo(np.int64).min + 1
    shown = np.where(own, lowest, scores)
    at = min(k, shown.shape[1]) - 1
    limit = -np.partition(-shown, at, axis=1)[:, at] if at >= 0 else np.zeros(len(q_ids), np.int64)
    row, column = np.nonzero((shown >= limit[:, None]) & ~own)
    return _best(q_ids[row], ids[column], scores[row, column], k)


def _bounds(centers: np.ndarray, reach: dict[int, float], cell: np.ndarray, far: np.ndarray, k: int) -> dict[int, np.ndarray]:
    """For each query group and each data group: the distance from its pivot that a vector must
    have to be needed."""
    norm = np.sqrt((centers**2).sum(1))
    out = {}
    for group, r in reach.items():
        between = centers @ centers[group]
        if len(cell) > k:
            least = between[cell] - r * norm[cell] - far * (norm[group] + r)
            sure = np.sort(least)[::-1][k]
        else:
            sure = -np.inf
        with np.errstate(invalid="ignore", divide="ignore"):
            need = (sure - between - r * norm) / (norm[group] + r)
        # A slack for rounding: bounds may only let too much through.
        out[group] = np.where(np.isnan(need), -np.inf, need - 1e-6 * (1 + np.abs(need)))
    return out
