import random

import numpy as np
import pytest

from newsflow.llm import mixing

from .helpers import docs

TARGETS = {"a": 0.5, "b": 0.3, "c": 0.2}


def rows_of(n, seed=0):
    rng, out = random.Random(seed), []
    for k in range(n):
        domain = rng.choices("abc", (0.7, 0.2, 0.1))[0]
        out.append((k, " ".join(f"{domain}{rng.randrange(30)}" if rng.random() < 0.7 else f"z{rng.randrange(50)}" for _ in range(rng.randint(5, 80))), domain))
    return out


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, domain string")


def test_classifier_on_held_out_rows(spark):
    rows = rows_of(600)
    model = mixing.fit_classifier(docs(spark, rows), labels(spark, [(r[0], r[2]) for r in rows[:400]]), tuple("abc"))
    x, _ = mixing.features([r[1].encode() for r in rows[400:]])
    right = model.posteriors(x).argmax(axis=1) == np.array(["abc".index(r[2]) for r in rows[400:]])
    assert right.mean() > 0.95


def test_sampled_features_travel_without_their_zeros():
    x, _ = mixing.features([r[1].encode() for r in rows_of(50, 2)] + [b"", None])
    packed = mixing._pack(x)
    assert packed.nbytes * 10 < x.nbytes
    assert np.array_equal(mixing._unpack(packed.to_pylist(), x.shape[1]), x)


def test_expected_tokens_meet_targets(spark):
    rows = rows_of(800, 1)
    mixed = mixing.mix_to_targets(docs(spark, rows), labels(spark, [(r[0], r[2]) for r in rows[:300]]), TARGETS, tokens=2.0).collect()
    tokens = np.array([r.n_tokens for r in mixed], float)
    posterior, rate = np.array([r.posterior for r in mixed]), np.array([r.rate for r in mixed])
    assert {r.doc_id: r.n_tokens for r in mixed} == {r[0]: len(r[1].split()) for r in rows}
    assert (rate >= 0).all()
    assert np.allclose((tokens * rate) @ posterior / tokens.sum() / 2, [0.5, 0.3, 0.2], atol=0.003)
    assert {r.gap for r in mixed} == {mixed[0].gap} and mixed[0].gap <= mixing.TOLERANCE
    copies = np.array([r["copies"] for r in mixed])
    assert (np.abs(copies - rate) < 1).all() and abs(tokens @ copies / (tokens @ rate) - 1) < 0.05


def least_squares(posterior, tokens, targets, rounds=40_000):
    """Smallest squared distance from the targets, by very many plain steps."""
    weighted = posterior * tokens[:, None]
    limit = np.linalg.eigvalsh(weighted.T @ posterior)[-1]
    rate = ahead = np.ones(len(posterior))
    for k in range(rounds):
        before, rate = rate, np.maximum(ahead - posterior @ (ahead @ weighted - targets) / limit, 0)
        ahead = rate + k / (k + 3) * (rate - before)
    return float(((rate @ weighted - targets) ** 2).sum())


@pytest.mark.parametrize("seed", range(6))
def test_fit_equals_least_squares(spark, seed):
    """Random posteriors: clear and nearly parallel domains, targets within reach and beyond it."""
    rng = np.random.default_rng(seed)
    n, size = 60, 3
    posterior = rng.dirichlet([0.3] * size, n) if seed % 2 else 0.9 / size + 0.1 * rng.dirichlet([0.5] * size, n)
    tokens = rng.integers(1, 400, n).astype(float)
    share = rng.dirichlet([1.0] * size) if seed < 4 else np.array([0.98, 0.01, 0.01])
    targets = share * tokens.sum()
    table = spark.createDataFrame([(int(t), p.tolist()) for t, p in zip(tokens, posterior, strict=True)], "n_tokens long, posterior array<double>")
    fit = mixing.fit_rates(table.repartition(3), targets, 1.0)
    rate = mixing._rates(posterior, 1.0, fit.steps)
    reached = rate @ (posterior * tokens[:, None])
    assert (rate >= 0).all() and np.allclose(reached, fit.reached) and fit.rounds <= 40
    best, own = least_squares(posterior, tokens, targets), float(((reached - targets) ** 2).sum())
    assert own <= best * 1.001 + (2e-3 * targets.sum()) ** 2
    assert fit.ended == ("targets met" if fit.gap <= mixing.TOLERANCE else "least squares")


def test_unreachable_target_is_least_squares(spark):
    # Only documents of two domains: the third target stays open, and the gap says so.
    posterior = np.array([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.5, 0.5, 0.0]])
    table = spark.createDataFrame([(10, p.tolist()) for p in posterior], "n_tokens long, posterior array<double>")
    fit = mixing.fit_rates(table, np.array([20.0, 0.0, 5.0]), 1.0)
    assert np.allclose(fit.reached, [20, 0, 0], atol=0.01) and fit.ended == "least squares" and np.isclose(fit.gap, 1)


def test_labels_of_other_documents_do_not_use_up_the_sample(spark):
    rows = rows_of(60, 3)
    known = [(r[0], r[2]) for r in rows] + [(10_000 + k, "a") for k in range(500)]
    model = mixing.fit_classifier(docs(spark, rows + rows[:1] * 200), labels(spark, known), tuple("abc"), rows=60)
    alone = mixing.fit_classifier(docs(spark, rows), labels(spark, known[:60]), tuple("abc"), rows=60)
    assert np.array_equal(model.weights, alone.weights) and model.weights.any()


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "a1 a2"), (3, "a1 a2"), (3, "a1 a2")]
    known = labels(spark, [(3, "a"), (3, "b"), (None, "a"), (1, None), (2, "other")])
    got = mixing.mix_to_targets(docs(spark, rows), known, TARGETS).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("1", 0), ("2", 0), ("3", 2), ("3", 2), ("None", 2)]
    assert len({r.rate for r in got if r.n_tokens}) == 1
    alone = mixing.mix_to_targets(docs(spark, rows), known.filter("false"), TARGETS).collect()
    assert np.allclose([r.posterior for r in alone], 1 / 3)
    assert mixing.mix_to_targets(docs(spark, []), known, TARGETS).collect() == []
