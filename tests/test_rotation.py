import random

import numpy as np
import pytest

from newsflow.operators.rotation import _chains, greedy_files


def by_hand(rows, limit, opened=None):
    """A writer that closes its file once the limit is reached."""
    out, state = {}, {}
    for part, k, size in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        seq, held = state.get(part) or (opened or {}).get(part, (0, 0))
        if held >= limit:
            seq, held = seq + 1, 0
        out[part, k] = seq
        state[part] = seq, held + size
    return out


def sample(seed, n, hot=0.7):
    rng = random.Random(seed)
    kinds = [lambda: rng.randrange(1, 40), lambda: rng.choice([1, 1, 300]), lambda: rng.choice([0, 5, 10])]
    return [("hot" if rng.random() < hot else rng.choice([None, "a", "b"]), k, kinds[seed % 3]()) for k in range(n)]


def files(spark, rows, limit, **options):
    df = spark.createDataFrame(rows, "part string, k int, size long").repartition(5)
    found = greedy_files(df, "part", ["k"], "size", limit, **options)
    assert found.columns == ["part", "k", "size", "bytes_before", "file_seq"]
    return {(r.part, r.k): r.file_seq for r in found.collect()}


@pytest.mark.parametrize("seed,limit,slices,fan", [(0, 100, 1, 64), (1, 100, 9, 64), (2, 7, 13, 2), (3, 1, 6, 2), (4, 1000, 11, 2), (5, 50, 17, 3), (0, 10**9, 5, 2)])
def test_files_equal_a_sequential_writer(spark, seed, limit, slices, fan):
    rows = sample(seed, 1500)
    assert files(spark, rows, limit, slices=slices, fan=fan) == by_hand(rows, limit)


def test_open_files_are_continued(spark):
    rows = sample(8, 400)
    opened = {"hot": (7, 60), "a": (2, 0), "b": (4, 5000), "other": (1, 1)}
    table = spark.createDataFrame([(p, s, b) for p, (s, b) in opened.items()], "part string, file_seq long, bytes long")
    assert files(spark, rows, 100, slices=7, fan=2, opened=table) == by_hand(rows, 100, opened)


def test_a_row_larger_than_the_limit_is_one_file(spark):
    rows = [("p", 0, 10), ("p", 1, 500), ("p", 2, 10), ("p", 3, 500), ("p", 4, 1)]
    assert files(spark, rows, 100) == {("p", 0): 0, ("p", 1): 0, ("p", 2): 1, ("p", 3): 1, ("p", 4): 2}


def test_empty_and_bad_limit(spark):
    assert files(spark, [], 100) == {}
    with pytest.raises(ValueError):
        files(spark, [("p", 0, 1)], 0)


def test_chains_equal_following_the_jumps():
    rng = np.random.default_rng(1)
    low = np.unique(rng.integers(0, 5000, 400))
    last, count = _chains(low, 333)
    for k in range(len(low)):
        at, n = k, 1
        while (nxt := int(np.searchsorted(low, low[at] + 333))) < len(low):
            at, n = nxt, n + 1
        assert (last[k], count[k]) == (low[at], n)


def test_no_task_holds_the_window(spark):
    """Jump tables hold the first bytes of a slice only, however many rows a window has."""
    rows = [("hot", k, 10) for k in range(3000)]
    df = spark.createDataFrame(rows, "part string, k int, size long")
    found = greedy_files(df, "part", ["k"], "size", 100, slices=8)
    assert found.agg({"file_seq": "max"}).first()[0] == 299
