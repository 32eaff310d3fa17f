import hashlib
import random
import re

import pytest

from newsflow.llm.fill_middle import cut, digests, outputs

from .helpers import docs, prose


def by_hand(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    rng = random.Random(3)
    made = [(k, "".join(rng.choice(["\n", "ab", "é漢", "<", "P>", "😀 x\n", " "]) for _ in range(rng.randrange(60)))) for k in range(150)]
    made += [(None, None), (None, "a\nb\n"), (500, ""), (501, "\n"), (502, "\n\n\n"), (503, "x <M> y\nz"), (504, "<P"), (505, "a\r\nb\rc")]
    made += [(506, "x" * 300_000 + "\n" + "é" * 100_000), (507, "\n".join(prose(1, 60_000))), (7, "again\nand again\n"), (7, "again\nand again\n"), (-4, "minus\none\n")]
    return made


@pytest.mark.parametrize("piece_bytes", [1 << 16, 5, 1])
def test_digests_equal_the_definition(spark, piece_bytes):
    table = [r for r in rows() if piece_bytes > 5 or len(r[1] or "") < 1000]
    wanted = [(d, *(made := by_hand(d, t))[:4], sha(made[4]), sha(t or "")) for d, t in table]
    got = digests(cut(docs(spark, table).repartition(5), piece_bytes=piece_bytes))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, wanted))
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}


def test_outputs_and_parameters(spark):
    table = rows()
    got = outputs(cut(docs(spark, table), seed=11, rate=60, spm=20)).collect()
    wanted = [(d, by_hand(d, t, 11, 60, 20)[1], by_hand(d, t, 11, 60, 20)[4]) for d, t in table]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, wanted))


def test_empty(spark):
    assert digests(cut(docs(spark, []))).collect() == []


def test_one_shuffle(spark):
    plan = digests(cut(docs(spark, rows()[:5])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
