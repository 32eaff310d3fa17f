import re

import numpy as np

from newsflow.llm.decontaminate import K, contamination, fingerprints
from newsflow.llm.words import U

from .helpers import docs, prose

ITEMS = "item_id long, text string, id long"


def brute_force(rows, items, width=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        words = split(text)
        n = min(len(words), width)
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(str(item))
    out = set()
    for doc, text in rows:
        words, hit, found = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (key := tuple(words[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[key]
        out.add((doc, len(words), len(hit), tuple(sorted(found))))
    return out


def test_rows_that_repeat_get_a_result_each(spark):
    bench = spark.createDataFrame([(1, " ".join(prose(0, 20)), 5), (2, "\u212aelvin \u0130s Short", 5)], ITEMS)
    rows = [(1, " ".join(prose(0, 20)))] * 3 + [(1, "clean text")] * 2 + [(None, None)] * 2 + [(2, "\u212aelvin \u0130s sHORT"), (3, "kelvin is short")]
    got = [(r.id, r.n_words, r.n_hit) for r in contamination(docs(spark, rows).repartition(4), bench).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, 20, 20)] * 3 + [(1, 2, 0)] * 2 + [(None, 0, 0)] * 2 + [(2, 3, 3), (3, 3, 0)]))


def test_against_brute_force(spark):
    long, other = prose(0, 60), prose(1, 30)
    items = [(1, " ".join(long)), (2, "Short item, of six words!"), (3, "one"), (4, None), (5, ""), (6, " ".join(long[20:45])), (7, " ".join(other)), (7, " ".join(other)), (None, "none")]
    rows = [(100 + k, " ".join([*prose(50 + k, k % 11), *long[k : k + 10 + k % 6], *prose(80 + k, 15)])) for k in range(30)]
    rows += [(1, "A short ITEM of six words"), (2, "short item; of six, words"), (3, None), (4, ""), (5, "one"), (6, " ".join(long + long)), (7, "x " + "-".join(other)), (None, " ".join(other))]
    bench = spark.createDataFrame([(*i, 5) for i in items], ITEMS)
    got = {(r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in contamination(docs(spark, rows), bench).collect()}
    assert got == brute_force(rows, [i for i in items if i[0] is not None])


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    got = contamination(docs(spark, [(1, "some words here")]), none).collect()
    assert [(r.id, r.n_words, r.n_hit, r["items"]) for r in got] == [(1, 3, 0, [])]
    assert contamination(docs(spark, []), spark.createDataFrame([(1, "a b", 1)], ITEMS)).collect() == []


def test_fingerprints_cover_every_window():
    rng = np.random.default_rng(0)
    for size in (0, 3, 13, 200):
        grams = rng.integers(0, 40, size).astype(U)  # with ties
        valid = np.arange(size) < size - K + 1
        at = set(fingerprints(grams, valid, np.zeros(size, np.int64), 8).tolist())
        for k in range(size - K + 1 - 8 + 1):
            least = min(grams[k : k + 8])
            assert any(j in at and grams[j] == least for j in range(k, k + 8))
