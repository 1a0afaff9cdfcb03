"""Exact top-k inner products by a vector-approximation file.

Every vector is stored twice: exactly, as integers ``floor(256 x)``, and as an
approximation of one byte per component, its cell in a uniform grid between
the smallest and the largest component of its block of vectors.  A query block
meets a candidate block in one task:

1. scan: cell edges bound every inner product from above and from below, by
   one product of the query's positive and one of its negative parts with the
   upper and lower edges (and the reverse);
2. the k-th best lower bound of a query is a floor under its k-th result, and
   candidates whose upper bound is below it are never looked at again;
3. the exact vectors of the rest are read in descending order of upper bound,
   some at a time, until the k-th best exact product is above all bounds left.

Every query thus keeps k rows per block, ties by the smaller id, and a window
over those few merges the blocks.  Blocks have at most ``block_rows`` rows, so
that memory is bounded; the work is queries times candidates, as the task
asks, and spreads over block pairs.  Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import stored

CELLS = 256
READ = 64
ROWS = "uid long, vec_id long, dims int, cells binary, low double, step double, vector binary"
HITS = "asker long, query_id long, vec_id long, score long"
LIMIT = float(1 << 53)


def approximations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function: the vector file's rows; vectors that take no part are left out."""
    for batch in batches:
        rows: list[tuple] = []
        ids = batch.column("uid").to_pylist(), batch.column("vec_id").to_pylist()
        for uid, vec_id, vector in zip(*ids, batch.column("vector")):
            if vec_id is None or not vector.is_valid or vector.values.null_count:
                continue
            x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            whole = np.floor(256 * x)
            if len(x) and np.abs(whole).max() >= LIMIT:
                raise ValueError("a component is beyond 2^45: its integer is not exact")
            low = float(whole.min()) if len(x) else 0.0
            step = max(1.0, np.ceil((float(whole.max()) - low + 1) / CELLS)) if len(x) else 1.0
            cells = ((whole - low) // step).astype(np.uint8)
            rows.append((uid, vec_id, len(x), cells.tobytes(), low, float(step), whole.astype("<i8").tobytes()))
        names = [c.split()[0] for c in ROWS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.binary()]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _matrix(column: pa.ChunkedArray, keep: np.ndarray, kind: str) -> np.ndarray:
    raw = column.take(pa.array(np.flatnonzero(keep))).to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, or minus infinity."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def search(queries: tuple, candidates: tuple, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(query's row, its id, candidate ids, scores)`` of each query's best k in one block.

    Queries are ``(rows, ids, exact)``, candidates ``(rows, ids, exact, lower
    edges, upper edges)`` in the order of their ids.  Rows, not ids, tell a query
    from the candidates.
    """
    q_rows, q_ids, q = queries
    c_rows, c_ids, exact, lower, upper = candidates
    plus, minus = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    at_most = plus @ upper.T + minus @ lower.T
    at_least = plus @ lower.T + minus @ upper.T
    own = q_rows[:, None] == c_rows[None, :]
    at_most[own] = at_least[own] = -np.inf
    # Bounds are sums of whole numbers: exact below 2^53, else widened by what rounding can take.
    size = float(np.abs(q).max(initial=0)) * float(np.abs(upper).max(initial=0) + np.abs(lower).max(initial=0)) * max(1, q.shape[1])
    wide = size >= LIMIT
    slack = size * 2.0**-48 if wide else 0.0
    floor = _kth(at_least, k) - slack
    for row in range(len(q_ids)):
        some = np.flatnonzero((at_most[row] + slack >= floor[row]) & ~own[row])
        some = some[np.argsort(-at_most[row, some], kind="stable")]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, object if wide else np.int64)
        for low in range(0, len(some), READ):
            if len(ids) >= k and at_most[row, some[low]] + slack < scores[k - 1]:
                break
            read = some[low : low + READ]
            if wide:
                products = [sum(int(a) * int(b) for a, b in zip(exact[r], q[row])) for r in read]
                products = np.array(products, object)
            else:
                products = exact[read] @ q[row]
            ids, scores = np.concatenate([ids, c_ids[read]]), np.concatenate([scores, products])
            best = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
            ids, scores = ids[best], scores[best]
        yield int(q_rows[row]), int(q_ids[row]), ids, scores


def search_blocks(k: int):
    """Group function: the hits of a query block in a candidate block, for each number of components."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        rows, ids, dims = (table.column(c).to_numpy() for c in ("uid", "vec_id", "dims"))
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for d in np.unique(dims[asks]):
            mine, theirs = asks & (dims == d), ~asks & (dims == d)
            if not theirs.any():
                continue
            exact = _matrix(table.column("vector"), theirs, "<i8").reshape(int(theirs.sum()), d)
            cells = _matrix(table.column("cells"), theirs, np.uint8).reshape(int(theirs.sum()), d).astype(np.float64)
            order = np.argsort(ids[theirs], kind="stable")
            step = table.column("step").to_numpy()[theirs][:, None]
            lower = table.column("low").to_numpy()[theirs][:, None] + cells * step
            q = _matrix(table.column("vector"), mine, "<i8").reshape(int(mine.sum()), d)
            block = (rows[theirs][order], ids[theirs][order], exact[order], lower[order], (lower + step - 1)[order])
            out += search((rows[mine], ids[mine], q), block, k)
        counts = [len(o[2]) for o in out]
        return pa.table(
            {
                "asker": pa.array(np.repeat([o[0] for o in out], counts), pa.int64()),
                "query_id": pa.array(np.repeat([o[1] for o in out], counts), pa.int64()),
                "vec_id": pa.array(np.concatenate([o[2] for o in out]) if out else [], pa.int64()),
                "score": pa.array([int(s) for o in out for s in o[3]], pa.int64()),
            }
        )

    return run


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    column: str = "embedding",
    block_rows: int = 4096,
    query_rows: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for each row where ``is_query`` holds.

    ``vectors`` has ``vec_id`` and an array column.  Rows with a null id, a null
    vector or a null or non-finite component take no part; vectors meet only
    vectors of the same length.  Every row stands for itself: of rows that repeat
    an id, each is a candidate for all others and each is asked for its own k.
    """
    given = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    # Stored with its number, by which a row is known from here on.
    file = stored(given.mapInArrow(approximations, ROWS), "vector-file")
    queries = file.where(is_query)
    rows, asked = file.count(), queries.count()
    blocks = max(1, -(-rows // block_rows))
    query_blocks = max(1, -(-asked // query_rows))
    # Bit-mixed numbers deal blocks evenly, copies of an id too; each candidate goes to every query block and each query to every block.
    deal = F.xxhash64("uid")
    held = file.select("*", F.pmod(deal, F.lit(blocks)).alias("block"), F.lit(False).alias("asks")).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    asking = queries.select("*", F.pmod(deal, F.lit(query_blocks)).alias("query_block"), F.lit(True).alias("asks"))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = (
        held.unionByName(asking)
        .groupBy("block", "query_block")
        .applyInArrow(search_blocks(k), HITS)
    )
    best = Window.partitionBy("asker").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
