import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsflow.llm import quality_lm as lm
from newsflow.llm.words import U

from .helpers import docs


def sentence(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "lo", "mi", "ter", "an"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def naive(texts):
    """Log-probability of a byte after four others, straight from the definition."""
    padded = ["\n" * 4 + t for t in texts]
    counts = {5: Counter(t[k : k + 5] for t in padded for k in range(len(t) - 4))}
    for n in range(4, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    spread = {n: Counter(c.values()) for n, c in counts.items()}
    off = {n: lm._discounts(*(s[k] for k in (1, 2, 3, 4))) for n, s in spread.items()}
    total, left = defaultdict(int), defaultdict(float)
    for table in counts.values():
        for g, c in table.items():
            total[g[:-1], len(g)] += c
            left[g[:-1], len(g)] += off[len(g)][min(c, 3)]

    def p(g):
        below = 1 / 256 if len(g) == 1 else p(g[1:])
        n = len(g)
        if not total[g[:-1], n]:
            return below
        c = counts[n][g]
        return (c - off[n][min(c, 3)] + left[g[:-1], n] * below) / total[g[:-1], n]

    return lambda g: np.log(p(g))


@pytest.mark.parametrize("shards", [1, 12])
def test_model_equals_definition(spark, shards):
    texts = [sentence(k) for k in range(12)]
    model, stored = lm.train(docs(spark, list(enumerate(texts))).select("text"), shards)
    tables = {r.shard: (lm._unpack(r["keys"]), np.frombuffer(r["counts"], np.int64)) for r in stored.collect()}
    log_p, rng = naive(texts), random.Random(1)
    grams = [t[k : k + 5] for t in texts[:3] for k in range(len(t) - 4)][:200]
    grams += ["".join(rng.choice("balomitern xyz") for _ in range(5)) for _ in range(200)]
    keys = np.unique(np.array([int.from_bytes(g.encode(), "big") for g in grams], U))
    shard = lm._shard_of(keys, shards)
    none = (np.zeros(0, U), np.zeros(0, np.int64))
    for s in range(shards):
        mine = keys[shard == s]
        got = model.log_probabilities(mine, *tables.get(s, none))
        assert np.allclose(got, [log_p(int(k).to_bytes(5, "big").decode()) for k in mine], atol=1e-9)


def test_probabilities_of_all_bytes_sum_to_one(spark):
    model, stored = lm.train(docs(spark, [(k, sentence(k)) for k in range(5)]).select("text"), 1)
    row = stored.first()
    table = (lm._unpack(row["keys"]), np.frombuffer(row["counts"], np.int64))
    for context in (b"balo", b"zzzz", b"o mi"):
        keys = (U(int.from_bytes(context, "big")) << U(8)) + np.arange(256, dtype=U)
        assert np.isclose(np.exp(model.log_probabilities(keys, *table)).sum(), 1)


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000).astype(U))
    values = np.arange(len(keys), dtype=np.float32)
    assert (lm._Lookup(keys, values).get(np.tile(keys[::-1], 2)) == np.tile(values[::-1], 2)).all()


def test_document_scores_equal_definition(spark):
    texts = [sentence(k) for k in range(12)]
    trusted = spark.createDataFrame([(k, False) for k in range(12)], "doc_id long, held_out boolean")
    got = {r.doc_id: r for r in lm.score(docs(spark, list(enumerate(texts)) + [(50, "xyz ba lo")]), trusted).collect()}
    log_p = naive(texts)
    for doc, text in ((0, texts[0]), (50, "xyz ba lo")):
        padded = "\n" * 4 + text
        nats = [-log_p(padded[k : k + 5]) for k in range(len(text))]
        assert np.isclose(got[doc].nats, np.mean(nats), atol=1e-4)
    worst = np.mean([-log_p(("\n" * 4 + "xyz ba lo")[k : k + 5]) for k in range(4)])
    assert np.isclose(got[50].tail_nats, worst, atol=1e-4)


def test_rejects_what_is_not_like_trusted_text(spark):
    rows = [(k, sentence(k), "de" if k % 3 else None) for k in range(300)]
    rows += [(1000, "QX#9 ZZ$% WWVV", "de"), (1001, f"{sentence(1)} qxwvz {sentence(2)}", "de"), (1002, None, "de"), (1003, "", None), (1004, "QQ##ZZXX", "new")]
    rows += [(None, sentence(77), "de"), (0, sentence(0), "de")]
    labels = spark.createDataFrame([(k, True) for k in range(250)] + [(260, None), (261, False), (None, True), (5, False)], "doc_id long, good boolean")
    got = lm.classify(docs(spark, rows), labels)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert got.count() == len(rows)
    assert not kept[1000] and not kept[1001] and not kept[1004]
    assert kept[1002] and kept[1003] and sum(kept[k] for k in range(300)) >= 285


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, good boolean")
    assert [r.kept for r in lm.classify(docs(spark, [(1, "any text")]), none).collect()] == [True]
    assert lm.classify(docs(spark, []), none).collect() == []


def test_trusted_documents_are_scored_without_their_fold(spark):
    texts = [sentence(k, 20) for k in range(30)]
    trusted = spark.createDataFrame([(k,) for k in range(30)], "doc_id long")
    got = {r.doc_id: r for r in lm.score(docs(spark, [*enumerate(texts), (50, texts[3])]), trusted, folds=3).collect()}
    fold = {r.doc_id: r.f for r in spark.createDataFrame([(k, got[k].version) for k in range(30)], "doc_id long, v long").selectExpr("doc_id", "pmod(xxhash64(v), 3) AS f").collect()}
    assert set(fold.values()) == {0, 1, 2} and sum(r.trusted for r in got.values()) == 30
    for doc, known in [(50, texts)] + [(k, [t for j, t in enumerate(texts) if fold[j] != fold[k]]) for k in (0, 1, 2, 7)]:
        log_p, padded = naive(known), "\n" * 4 + (texts[3] if doc == 50 else texts[doc])
        assert np.isclose(got[doc].nats, -np.mean([log_p(padded[k : k + 5]) for k in range(len(padded) - 4)]), atol=1e-4), doc


def test_limits_of_a_small_language_rest_on_all_its_trusted_documents(spark):
    # Below 100 trusted documents the quantile is their maximum: none of them is rejected.
    rows = [(k, sentence(k), "big") for k in range(150)] + [(1000 + k, sentence(5000 + k, 8).replace("a", "u"), "small") for k in range(30)]
    labels = spark.createDataFrame([(r[0], True) for r in rows], "doc_id long, good boolean")
    kept = {r.doc_id: r.kept for r in lm.classify(docs(spark, rows), labels).collect()}
    assert all(kept[1000 + k] for k in range(30))


def test_limits_are_found_once_and_stored(spark):
    rows = [(k, sentence(k), "big") for k in range(40)] + [(100 + k, sentence(900 + k), None) for k in range(20)] + [(200, sentence(3).upper(), "other"), (201, None, "big")]
    trusted = set(range(0, 40, 2)) | set(range(100, 110))
    labels = spark.createDataFrame([(k, True) for k in trusted], "doc_id long, good boolean")
    judged = lm.classify(docs(spark, rows), labels, quantile=0.6)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    got, lang = {r.doc_id: r for r in judged.collect()}, {r[0]: r[2] for r in rows}
    cells = {k: [round(1000 * np.log(p)) for p in (r.perplexity, r.tail_perplexity)] for k, r in got.items()}
    for k, r in got.items():
        same = [d for d in trusted if lang[d] == lang[k]] or list(trusted)
        limits = [sorted(cells[d][m] for d in same)[int(np.ceil(0.6 * len(same))) - 1] for m in (0, 1)]
        assert r.kept == (k == 201 or all(c <= x for c, x in zip(cells[k], limits, strict=True))), k


def test_scores_do_not_depend_on_how_many_groups_a_task_answers(spark):
    rows = [(k, sentence(k, 5 + 7 * k % 50)) for k in range(60)]
    trusted = spark.createDataFrame([(k,) for k in range(0, 60, 2)], "doc_id long")
    few, many = (sorted(map(repr, lm.score(docs(spark, rows), trusted, folds=3, asking=n).collect())) for n in (4, 10_000))
    assert few == many and len(few) == 60
