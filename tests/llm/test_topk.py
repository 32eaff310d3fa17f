import numpy as np
from pyspark.sql import functions as F

from newsflow.llm import topk

ROWS = "vec_id long, embedding array<float>, dim int, v string, block int"


def brute_force(rows, k):
    whole = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, qv in sorted({(i, tuple(v)) for i, v in whole if i % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(qv))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, rows, k=10, **options):
    table = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], ROWS)
    return sorted(tuple(r) for r in topk.top_k(topk.scaled(table), F.col("vec_id") % 100 == 0, k, **options).select("query_id", "rank", "vec_id", "score").collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(650)]
    # ties, copies, very long and zero vectors
    rows += [(1000 + k, rows[k % 5][1]) for k in range(40)] + [(1100, [30.0] * 8), (1101, [0.0] * 8), (1200, [-50.0] * 8)]
    rows += [(1300, None), (1400, [1.0, None] + [0.0] * 6), (1500, [float("nan")] * 8), (1600, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    assert search(spark, rows) == brute_force(rows, 10)
    assert search(spark, rows, k=3, pivots=4) == brute_force(rows, 3)


def test_meetings_without_a_broadcast(spark, monkeypatch):
    for name, value in (("ROWS_PER_BLOCK", 50), ("QUERIES_PER_BLOCK", 2), ("BROADCAST_BYTES", 0), ("BLOCKS_PER_TASK", 3)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=4 + k % 2).tolist()) for k in range(0, 1400, 2)] + [(k, rng.normal(size=4).tolist()) for k in range(1, 400, 2)]
    assert search(spark, rows) == brute_force(rows, 10)


def test_few_rows_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (100, [1.0]), (101, [2.0]), (200, [])]
    assert search(spark, rows) == brute_force(rows, 10)


def test_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]
    assert [r[1:] for r in search(spark, rows)] == [(1, 1, 2097152), (2, 1, 2097152), (3, 2, 1048576)]


def test_empty(spark):
    assert search(spark, []) == []


def test_stops_early():
    """On clustered rows most are never evaluated."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (50, 16))
    vectors = centres[rng.integers(0, 50, 5000)] + rng.integers(-20, 20, (5000, 16))
    vectors = np.rint(1024 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)

    class Counting(np.ndarray):
        seen = 0

        def __getitem__(self, key):
            if self.ndim == 2 and isinstance(key, np.ndarray):
                Counting.seen += len(key)
            return super().__getitem__(key)

    ids = np.arange(5000)
    top = float((vectors.astype(float) ** 2).sum(axis=1).max())
    pivots = vectors[100:132].astype(float)
    table = topk._distances(vectors.astype(float), (vectors.astype(float) ** 2).sum(axis=1), pivots, top)
    got = list(topk.search_block(ids[:1], vectors[:1], ids, vectors.view(Counting), table, ids[100:132], pivots, top, 10))
    wanted = sorted(((-int(v @ vectors[0]), i) for i, v in enumerate(vectors) if i), key=lambda x: x)[:10]
    assert [(-int(s), i) for _, i, s in got] == wanted and Counting.seen < 500
