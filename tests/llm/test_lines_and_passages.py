import random

import pytest

from newsflow.llm.line_dedup import dedup_lines
from newsflow.llm.substring_dedup import COVER, PERIOD, remove_repeated_passages

from .helpers import docs, prose

LINE = "A line of more than ten characters"


def test_lines(spark):
    rows = [(1, f"{LINE}\nshort\nown line number one"), (2, f"short\n \t{LINE.upper()} \r\n{LINE}"), (3, None), (4, ""), (None, LINE), (5, f"{LINE}x"), (2, f"short\n \t{LINE.upper()} \r\n{LINE}")]
    got = dedup_lines(docs(spark, rows))
    assert got.columns[:11] == docs(spark, rows).columns
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str)
    assert found == sorted([(1, rows[0][1], 3, 0), (2, "short", 3, 2), (2, "short", 3, 2), (3, "", 1, 0), (4, "", 1, 0), (None, LINE, 1, 0), (5, f"{LINE}x", 1, 0)], key=str)


def test_line_repeated_in_one_document_stays(spark):
    got = dedup_lines(docs(spark, [(1, f"{LINE}\n{LINE}"), (2, "none")]))
    assert {r.doc_id: r.n_dropped for r in got.collect()} == {1: 0, 2: 0}


def test_line_threshold(spark):
    rows = [(k, LINE) for k in range(3)] + [(k, "another line of text") for k in range(2)]
    got = {(r.doc_id, r.text) for r in dedup_lines(docs(spark, rows), min_docs=3).collect()}
    assert (2, "") in got and (1, "another line of text") in got


@pytest.mark.parametrize("operator", [dedup_lines, remove_repeated_passages])
def test_empty(spark, operator):
    assert operator(docs(spark, [])).collect() == []


def brute_force(rows, width):
    owner = {}
    for doc, text in rows:
        words = (text or "").split()
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            owner[key] = min(owner.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").split()
        gone = {j for k in range(len(words) - width + 1) if owner[tuple(words[k : k + width])] < doc for j in range(k, k + width)}
        out.append((doc, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return sorted(out)


@pytest.mark.parametrize("width", [13, 20])
def test_passages_at_all_alignments(spark, width):
    shared, rng, rows = prose(0, 40), random.Random(1), []
    for doc in range(40):
        # every length around the window and every offset of the passage
        piece = shared[: width - 2 + doc % 5]
        rows.append((doc, " ".join([*prose(100 + doc, doc % 9), *piece, *prose(200 + doc, rng.randrange(30))])))
    rows += [(50, None), (51, ""), (52, rows[3][1]), (53, " ".join(prose(9, 30) * 3)), (54, "\t ".join(prose(9, 30)))]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in remove_repeated_passages(docs(spark, rows), width).collect())
    assert got == brute_force(rows, width)


def test_passage_rows_without_id_or_repeated(spark):
    text = " ".join(prose(3, 30))
    got = sorted(((r.doc_id, r.n_removed) for r in remove_repeated_passages(docs(spark, [(None, text), (4, text), (4, text), (9, text)])).collect()), key=str)
    assert got == sorted([(None, 0), (4, 0), (4, 0), (9, 30)], key=str)


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
