import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import language_mix
from newsflow.llm.language_mix import BITS, PENALTY, fit, grams, held_out, identify, mixture
from newsflow.llm.queries import QUERIES

from .helpers import docs

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return table, fit(table.filter(~held_out(F.col("doc_id"))).select("lang", "text"))


def test_held_out_accuracy(spark):
    table = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op12_language_id"](spark, FOLDER).collect()
    assert len(got) == len(table) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    judged = [r for r in got if r.held_out]
    assert len(judged) > 200 and sum(r.lang_pred == table[r.doc_id] for r in judged) >= 0.99 * len(judged)


def test_learns_nothing_from_held_out_rows(spark):
    rows = [(k, "held out words", "xx") if zlib.crc32(str(k).encode()) % 4 == 2 else (k, "other text", "yy") for k in range(40)]
    table = docs(spark, rows)
    assert fit(table.filter(~held_out(F.col("doc_id"))).select("lang", "text")).langs == ["yy"]


def plain_grams(text):
    """(context, byte) pairs of every word of one text, by a loop."""
    data, out, word = text.lower().encode() + b" ", [], None
    for byte in data:
        letter = byte >= 0x80 or 97 <= byte <= 122
        if letter and word is None:
            word = b" "
            out.append([])
        if word is not None:
            out[-1].append((word[-3:], byte if letter else 32))
            word = word + bytes([byte]) if letter else None
    return out


def test_grams_and_counts_equal_a_loop(spark):
    texts = ["A bc, Défg h1i\n", "", "x", "--", "Ünï cödé"]
    found = grams([t.lower().encode() for t in texts])
    wanted = [w for t in texts for w in plain_grams(t)]
    assert list(np.diff(np.append(found.first, len(found.gram)))) == [len(w) for w in wanted]
    flat = [g for w in wanted for g in w]
    for kind, keys in ((found.gram, flat), (found.context, [c for c, _ in flat])):
        buckets = {}
        for bucket, key in zip(kind.tolist(), keys, strict=True):
            assert buckets.setdefault(key, bucket) == bucket
    model = fit(docs(spark, [(k, t, "aa") for k, t in enumerate(texts)]).select("lang", "text"))
    counts = np.bincount(found.gram, minlength=1 << BITS)
    assert np.allclose(np.exp(model.gram[0]) - 1 / 64, counts, atol=1e-4) and model.langs == ["aa"]


def by_hand(logs, prior):
    """One document: proportions, penalised likelihood, languages taken out least first."""
    top = logs.max(1, keepdims=True)
    p = np.exp(np.maximum(logs - top, -500)) * (1 - np.exp(-8)) + np.exp(-8)
    n = len(p)

    def em(langs):
        base = prior[langs] / prior[langs].sum()
        share = base
        for _ in range(15):
            r = p[:, langs] * share
            r /= r.sum(1, keepdims=True)
            share = (r.sum(0) + base) / (n + 1)
        return share, np.log((p[:, langs] * share).sum(1)).sum() - PENALTY * np.log(n + 1) * len(langs)

    langs = list(range(len(prior)))
    share, value = em(langs)
    small = [k for k in langs if share[k] * n >= 0.5 or k == int(share.argmax())]
    got, worth = em(small)
    if worth >= value - 1e-9:
        langs, share, value = small, got, worth
    while len(langs) > 1:
        fewer = [k for j, k in enumerate(langs) if j != int(share.argmin())]
        got, worth = em(fewer)
        if worth < value - 1e-9:
            break
        langs, share, value = fewer, got, worth
    return langs, share


def test_mixture_equals_a_loop():
    rng = np.random.default_rng(4)
    prior = np.array([0.5, 0.2, 0.2, 0.1])
    count = rng.integers(1, 60, 80)
    logs = [rng.normal(-20, 3, (n, 4)) + 4 * np.eye(4)[rng.choice(4, n, p=rng.dirichlet([0.3] * 4))] for n in count]
    whole, chosen, share = mixture(np.concatenate(logs), np.ones(count.sum()), count, prior)
    sizes = set()
    for k, one in enumerate(logs):
        langs, shares = by_hand(one, prior)
        assert list(np.flatnonzero(chosen[k])) == langs and np.allclose(share[k][langs], shares)
        sizes.add(len(langs))
    assert sizes >= {1, 2} and np.allclose(whole.sum(1), 1)


def test_weights_equal_repeated_words():
    rng = np.random.default_rng(5)
    logs = rng.normal(-20, 3, (12, 3))
    weight = rng.integers(1, 5, 12)
    a = mixture(logs, weight.astype(float), np.array([12]), np.ones(3) / 3)
    b = mixture(np.repeat(logs, weight, axis=0), np.ones(weight.sum()), np.array([weight.sum()]), np.ones(3) / 3)
    assert all(np.allclose(x, y) for x, y in zip(a, b, strict=True))


def test_documents_of_two_languages(spark, learned):
    table, model = learned
    texts = {lang: [r.text for r in table.filter(F.col("lang") == lang).limit(10).collect()] for lang in ("fr", "de")}
    rows = [(k, f"{a}\n{b}") for k, (a, b) in enumerate(zip(texts["fr"], texts["de"], strict=True))]
    for r in identify(docs(spark, rows), model).collect():
        assert {"fr", "de"} <= set(r.languages) and abs(sum(r.shares) - 1) < 1e-6


def test_awkward_rows(spark, learned):
    _, model = learned
    long = "the and of to in is that " * 200_000
    rows = [(None, None), (1, ""), (2, "123 --- \n"), (3, "— « »"), (None, "the of and is"), (3, "der die das und ist"), (4, long), (5, "x" * 3_000_000), (6, "汉字"), (6, "汉字")]
    got = identify(docs(spark, rows), model).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.score) for r in got if r.lang_pred == "und") == [("1", 0.0), ("2", 0.0), ("3", 0.0), ("None", 0.0)]
    assert {r.lang_pred for r in got if r.doc_id in (4, None) and r.languages} == {"en"}
    assert [r.lang_pred for r in got if r.doc_id == 3 and r.languages] == ["de"]
    assert identify(docs(spark, []), model).collect() == []
    nothing = fit(docs(spark, [(1, None, "en"), (2, "text", None)]).select("lang", "text"))
    assert nothing.langs == [] and identify(docs(spark, rows[4:5]), nothing).first().lang_pred == "und"


def test_long_texts_are_judged_as_short_ones(learned, monkeypatch):
    table, model = learned
    texts = [r.text for r in table.limit(40).collect() if len(r.text) > 500]
    whole = list(language_mix._judge(model, texts))
    monkeypatch.setattr(language_mix, "CHUNK_BYTES", 800)
    monkeypatch.setattr(language_mix, "LONGEST_RUN", 200)
    pieced = list(language_mix._judge(model, texts))
    for a, b in zip(whole, pieced, strict=True):
        assert a[0] == b[0] and a[2] == b[2] and abs(a[1] - b[1]) < 1e-3
