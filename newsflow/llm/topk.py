"""Exact top-k search by inner product with a pivot table.

Vectors become integers. With M the largest norm, every row x is thought of as (x, sqrt(M^2 - |x|^2)) and every query q
as (q, 0); then the squared distance of both is |q|^2 + M^2 - 2 <q, x>, so nearest means highest inner product and the
triangle inequality holds. Distances of all rows to the pivots are computed once (the pivot table). For a query, the
largest |d(q, p) - d(x, p)| over the pivots is a lower bound of d(q, x). Rows are evaluated in the order of their
bounds, a batch at a time, until the next bound says that no later row can reach the k-th score so far.

Rows, with their distances to the pivots, and queries are packed in blocks and stored; every block of queries meets every block of
rows: the search itself is over all rows. Each meeting returns k rows per query at most, and they are merged per query. The pivots are a fixed number of
rows, the least by a hash, so neither they nor the norm grow with the data.

Defined cases: a vector that is null, or holds a null or a non-finite component, takes no part, neither does a row
without id. Vectors of different lengths are compared only with those of their own length. Results are exact while inner products stay below 2^63. Repeated rows are candidates
each; as a query an id counts once, with its least vector, and never meets rows of its own id. Ties go to the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.tables import materialize

PIVOTS = 32
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 512
FIRST = 64  # candidates evaluated before the first test; doubled from then on

BROADCAST_BYTES = 32 << 20  # of packed queries
BLOCKS_PER_TASK = 16

_BLOCK = "dim int, block int, ids binary, vectors binary, distances binary"
Pivots = dict[int, tuple[np.ndarray, np.ndarray]]


def scaled(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """(vec_id, dim, v): components as floor(factor * x) for the vectors that take part."""
    x = F.col("embedding")
    whole = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(whole).select("vec_id", F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c.cast("double") * factor).cast("long")).alias("v"))


def _blocks(rows: DataFrame, per_block: int, pivots: Pivots | None = None, tops: dict[int, float] | None = None) -> tuple[DataFrame, int]:
    """Rows packed in blocks of about ``per_block``, by a hash of the id, and the number of blocks (per dimension).

    With ``pivots`` the distances of all rows to them are part of the block: the pivot table.
    """
    count = max(1, -(-rows.count() // per_block))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = np.ascontiguousarray(table["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)[order])
        distances = b""
        if pivots is not None:
            whole = vectors.astype(np.float64)
            distances = _distances(whole, (whole**2).sum(axis=1), pivots[dim][1], tops[dim]).tobytes()
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "block": table["block"].slice(0, 1),
                "ids": [ids[order].tobytes()],
                "vectors": [vectors.tobytes()],
                "distances": [distances],
            }
        )

    return materialize(rows.withColumn("block", block).groupBy("dim", "block").applyInArrow(pack, _BLOCK), "vector-blocks"), count


def _distances(vectors: np.ndarray, norms: np.ndarray, pivots: np.ndarray, top: float) -> np.ndarray:
    """Distance of each row (lifted to norm M) to each pivot (lifted too)."""
    own, other = np.sqrt(np.maximum(top - norms, 0)), np.sqrt(np.maximum(top - (pivots**2).sum(axis=1), 0))
    squared = 2 * top - 2 * (vectors @ pivots.T) - 2 * own[:, None] * other[None, :]
    return np.sqrt(np.maximum(squared, 0))


def _query_distances(queries: np.ndarray, pivots: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum((queries**2).sum(axis=1)[:, None] + top - 2 * (queries @ pivots.T), 0))


def search_block(q_ids, queries, ids, vectors, table, pivot_ids, pivots, top, k):
    """k best (query id, id, score) of one block of rows for each query of one block; see the module's text.

    ``table``: distances of the rows to the pivots.
    """
    asked = queries.astype(np.float64)
    to_pivots, squares = _query_distances(asked, pivots, top), (asked**2).sum(axis=1)
    seen = queries @ pivots.astype(np.int64).T
    # Bounds are loosened by more than square roots can be off by rounding.
    slack = 1e-6 * max(top, float(squares.max(initial=1.0)), 1.0) ** 0.5
    for i, q in enumerate(q_ids.tolist()):
        # Pivots are rows, so their k-th score is reached already (by other rows than the query's own).
        others = np.sort(seen[i][pivot_ids != q])
        least = others[-k] if len(others) >= k else -np.inf
        bound = np.abs(table - to_pivots[i]).max(axis=1) - slack
        # Highest inner product that the bound allows.
        best = (squares[i] + top - np.maximum(bound, 0) ** 2) / 2 + 1e-6 * max(top, 1.0)
        able = np.flatnonzero((best >= least) & (ids != q))
        able = able[np.argsort(-best[able], kind="stable")]
        found_ids, found, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST
        while done < len(able):
            if len(found) >= k and best[able[done]] < found[k - 1]:
                break
            part = able[done : done + step]
            found_ids = np.concatenate([found_ids, ids[part]])
            found = np.concatenate([found, vectors[part] @ queries[i]])
            order = np.lexsort((found_ids, -found))[:k]
            found_ids, found = found_ids[order], found[order]
            done, step = done + len(part), step * 2
        for one, score in zip(found_ids.tolist(), found.tolist(), strict=True):
            yield q, one, score


def _searcher(pivots: Pivots, tops: dict[int, float], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                dim, q_ids, queries, ids, vectors, distances = (batch[c][at].as_py() for c in ("dim", "q_ids", "queries", "ids", "vectors", "distances"))
                q, one = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                of_q, of_one = (np.frombuffer(x, np.int64).reshape(len(n), dim) for x, n in ((queries, q), (vectors, one)))
                table = np.frombuffer(distances).reshape(len(one), -1)
                found = list(search_block(q, of_q, one, of_one, table, *pivots[dim], tops[dim], k))
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 10, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``scaled`` that ``is_query`` marks, the ``k`` highest inner
    products with the other rows. Jobs run while this is called."""
    square = F.aggregate("v", F.lit(0.0).cast("double"), lambda a, c: a + c.cast("double") * c.cast("double"))
    tops = {r.dim: float(r.top) for r in rows.groupBy("dim").agg(F.max(square).alias("top")).collect()}
    chosen: Pivots = {}
    for dim in tops:
        least = rows.filter(F.col("dim") == dim).select("vec_id", "v").dropDuplicates(["vec_id"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
        chosen[dim] = (np.array([r.vec_id for r in least]), np.array([r.v for r in least], np.float64).reshape(len(least), dim))
    packed, q_blocks = _blocks(rows.filter(is_query).groupBy("vec_id", "dim").agg(F.min("v").alias("v")), QUERIES_PER_BLOCK)
    queries = packed.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("queries"))
    blocks, n_blocks = _blocks(rows, ROWS_PER_BLOCK, chosen, tops)
    found = _meetings(blocks, n_blocks, queries, q_blocks).select("dim", "q_ids", "queries", "ids", "vectors", "distances")
    found = found.mapInArrow(_searcher(chosen, tops, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meetings(blocks: DataFrame, n_blocks: int, queries: DataFrame, q_blocks: int) -> DataFrame:
    """Every block of rows with every block of queries of its dimension.

    Queries of few bytes are sent to all tasks, and rows travel once. Beyond that a task gets one block of queries and some blocks of rows.
    """
    size = queries.agg(F.sum(F.octet_length("queries") + F.octet_length("q_ids"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return blocks.repartition(n_blocks, "dim", "block").join(F.broadcast(queries), "dim")
    salts = -(-n_blocks // BLOCKS_PER_TASK)
    salted = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = blocks.withColumn("salt", F.pmod("block", F.lit(salts))).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    return spread.repartition(salts * q_blocks, "dim", "q_block", "salt").join(salted.hint("shuffle_hash"), ["dim", "q_block", "salt"])
