"""Nearest neighbours of stated queries by a block matrix join in int8, exact in the end.

Vectors are scaled to length 1, rounded to whole numbers of -127 to 127 with a scale of their own,
and packed into blocks. Each pair of a query block and a vector block is one tile: the product of
its two integer matrices gives approximate cosines, and the lengths of the rounding errors bound how
far each can be off. A pair whose upper bound is below the k-th best lower bound of its query in the
tile is none of the k nearest; the others are computed again from the original components in double
precision. Each tile passes on its k best, and heaps merge them by query.

Equal vectors of a block are one row with their k + 1 smallest ids: ties go to smaller ids, so the
others cannot be found. Block sizes decide nothing: results are those of comparing every query with
every row.

Vectors that are null or zero, or hold a null or a number that is not finite, take no part, nor do
rows with a null id. Vectors are compared with those of their own dimension. Repeated rows: equal
findings of one query count once, and no row of a query's own id is found. Empty table or no
queries: no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import prepared
from dossierlake.session import materialize

NEIGHBOURS = 5
QUERY_ROWS = 1024
BLOCK_ROWS = 4096
EXACT_PAIRS = 1 << 16  # pairs that are computed again at a time

BLOCK = "dim int, ids binary, vectors binary"
FOUND = "query_id bigint, vec_id bigint, score double"


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of valid vectors of one dimension: ids and components, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, values = held.pop(dim)
            row = [[dim], [np.array(ids, "<i8").tobytes()], [b"".join(values)]]
            kinds = (pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array(x, k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["dim", "ids", "vectors"])

        for batch in batches:
            for vec_id, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if vec_id is None or vector is None or None in vector:
                    continue
                v = np.array(vector, "<f8")
                if not len(v) or not np.isfinite(v).all() or not v.any():
                    continue
                ids, values = held.setdefault(len(v), ([], []))
                ids.append(vec_id)
                values.append(v.tobytes())
                if len(ids) == rows:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(pack, BLOCK)


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths, summed in the order of the components."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += x[:, i] * x[:, i]
    return np.sqrt(total)


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, lengths of the rounded rows and of the rounding errors."""
    largest = np.abs(x).max(1, keepdims=True)
    y = x / largest
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    scale = np.abs(y).max(1) / 127
    whole = np.rint(y / scale[:, None]).astype(np.int8)
    back = whole * scale[:, None]
    return whole, scale, np.sqrt((back * back).sum(1)), np.sqrt(((y - back) ** 2).sum(1))


def cosines(q: np.ndarray, x: np.ndarray, q_len: np.ndarray, x_len: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, summed in the order of the components: equal rows score equally."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        total += q[:, i] * x[:, i]
    return total / (q_len * x_len)


def collapse(ids: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct rows, and the smallest ids of each."""
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    group = np.unique(raw, return_inverse=True)[1]
    order = np.lexsort((ids, group))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(group[order]) != 0) | (np.diff(ids[order]) != 0)
    order = order[new]
    group, ids = group[order], ids[order]
    cuts = np.flatnonzero(np.diff(group)) + 1
    first = np.concatenate([[0], cuts])
    return x[order[first]], [g[:keep] for g in np.split(ids, cuts)]


def tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
    """The k nearest rows of the block for each query: query, id, score."""
    x, members = collapse(ids, x, k + 1)
    first = np.array([m[0] for m in members])
    qi, qs, qn, qe = rounded(q)
    xi, xs, xn, xe = rounded(x)
    # float32 holds the integer sums exactly up to dimension 1040; wider blocks take float64.
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    near = (qi.astype(kind) @ xi.astype(kind).T).astype(np.float64) * qs[:, None] * xs
    room = qn[:, None] * xe + qe[:, None] * xn + qe[:, None] * xe + 1e-9
    # A query's own row gives no bound.
    low = near - room
    own = {}
    for j, m in enumerate(members):
        for i in m.tolist():
            own.setdefault(i, []).append(j)
    for r, i in enumerate(q_ids.tolist()):
        for j in own.get(i, ()):
            low[r, j] = -np.inf
    if low.shape[1] > k:
        bound = -np.partition(-low, k - 1, axis=1)[:, k - 1]
    else:
        bound = np.full(len(q), -np.inf)
    row, column = np.nonzero(near + room >= bound[:, None])
    q_len, x_len = lengths(q), lengths(x)
    score = np.empty(len(row))
    for a in range(0, len(row), EXACT_PAIRS):
        r, c = row[a : a + EXACT_PAIRS], column[a : a + EXACT_PAIRS]
        score[a : a + EXACT_PAIRS] = cosines(q[r], x[c], q_len[r], x_len[c])
    order = np.lexsort((first[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    begin = np.searchsorted(row, np.arange(len(q) + 1))
    for r, query in enumerate(q_ids.tolist()):
        best: list[tuple] = []
        for n in range(begin[r], begin[r + 1]):
            if len(best) == k and -score[n] > best[-1][0]:
                break
            found = [(-score[n], i) for i in members[column[n]].tolist() if i != query]
            best = heapq.nsmallest(k, best + found)
        for minus, i in best:
            yield query, i, -minus


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest cosine for each query row."""
    spark = prepared(vectors.sparkSession)
    columns = [F.col(id_col).cast("bigint"), F.col(vector_col).cast("array<double>")]
    number = F.monotonically_increasing_id()
    asked = materialize(blocks(queries.select(*columns), QUERY_ROWS), "query-blocks")
    rows = materialize(blocks(vectors.select(*columns), BLOCK_ROWS).withColumn("block", number), "blocks")
    # Every query block meets every block: the query blocks are dealt to each block's number.
    places = rows.select("dim", "block")
    asked = asked.select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    asked = asked.join(places, "dim")
    tiles = rows.join(asked, ["dim", "block"]).select("dim", "ids", "vectors", "q_ids", "q_vectors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, x, q_ids, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = tile(
                    np.frombuffer(q_ids, "<i8"),
                    np.frombuffer(q, "<f8").reshape(-1, dim),
                    np.frombuffer(ids, "<i8"),
                    np.frombuffer(x, "<f8").reshape(-1, dim),
                    k,
                )
                columns = list(zip(*found, strict=True)) or [(), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.float64())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []
        out: list[tuple] = []

        def close() -> None:
            for rank, (minus, i) in enumerate(sorted((-s, -i) for s, i in heap), 1):
                out.append((query, rank, i, -minus))

        for batch in batches:
            for q, i, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if q != query:
                    close()
                    query, heap = q, []
                if (s, -i) in heap:
                    continue
                if len(heap) < k:
                    heapq.heappush(heap, (s, -i))
                else:
                    heapq.heappushpop(heap, (s, -i))
            yield _ranked(out)
            out.clear()
        close()
        yield _ranked(out)

    best = tiles.mapInArrow(search, FOUND)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = best.repartition(parts, "query_id").sortWithinPartitions("query_id")
    return best.mapInArrow(merge, "query_id bigint, rank int, vec_id bigint, score double")


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["query_id", "rank", "vec_id", "score"])
