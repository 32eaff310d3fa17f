import re

import corpus_pipeline
from newsflow.llm.near_dedup import banding
from newsflow.llm.queries import QUERIES

from .helpers import docs, prose

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = table.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, table, FOLDER)
        assert done.columns == table.columns, name
        rows = done.collect()
        assert 0 < len(rows) <= seen and len({r.doc_id for r in rows}) == len(rows), name
        table, seen = spark.createDataFrame(rows, table.schema), len(rows)
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Decisions of the registered queries, applied one after another to the first two stages."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rejected = {r.doc_id for r in QUERIES["op5_quality_classifier"](spark, FOLDER).filter("NOT kept").collect()}
    first = corpus_pipeline.keep_quality(spark, table, FOLDER)
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in table.collect()} - rejected
    rows = sorted((r.doc_id, r.text) for r in first.collect())
    owner = {}
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            owner.setdefault(key(line), doc)
    wanted = {doc: "\n".join(line for line in (text or "").split("\n") if len(key(line)) < 10 or owner[key(line)] == doc) for doc, text in rows}
    got = corpus_pipeline.drop_repeated_lines(spark, first, FOLDER).collect()
    assert {r.doc_id: r.text for r in got} == wanted and all(r.n_chars == len(r.text) for r in got)


def test_awkward_rows(spark):
    rows = [(None, None), (None, "some text"), (1, ""), (2, None), (3, "some text"), (3, "some text")]
    for name, stage in corpus_pipeline.STAGES:
        table = docs(spark, rows)
        done = stage(spark, table, FOLDER).collect()
        assert {(r.doc_id) for r in done} >= {None, 1, 2}, name
        assert stage(spark, table.filter("false"), FOLDER).collect() == [], name


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "source", "n_tokens", "rate", "copies", "gap"] and got.count() > 50


def test_contamination_stage_equals_brute_force(spark):
    """A document goes if a twentieth of its words lie in windows of 13 words of a benchmark item (or in a whole shorter one)."""
    words = lambda text: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(i[k : k + 13]) for i in items for k in range(max(1, len(i) - 12)) if i}
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = set()
    for r in table.collect():
        own = words(r.text)
        hit = {j for n in {len(w) for w in windows} for k in range(len(own) - n + 1) if tuple(own[k : k + n]) in windows for j in range(k, k + n)}
        clean |= set() if hit and 20 * len(hit) >= len(own) else {r.doc_id}
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, table, FOLDER).collect()} == clean
    assert len(clean) < table.count()


def test_mixture_meets_its_targets(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = corpus_pipeline.mix_sources(spark, table, FOLDER).collect()
    lang = {r.doc_id: r.lang for r in table.collect()}
    total = sum(r.n_tokens for r in got)
    assert got[0].gap < 0.01 and total == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in table.collect())
    for name, share in corpus_pipeline.TARGETS.items():
        assert abs(sum(r.n_tokens * r.rate for r in got if lang[r.doc_id] == name) / total - share) < 0.05


def test_repeated_rows_become_one(spark):
    one, other = " ".join(prose(1, 60)), " ".join(prose(2, 60))
    rows = [(1, one)] * 5 + [(1, other)] + [(None, one)] * 2 + [(2, " ".join(prose(3, 60)))]
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs(spark, rows), FOLDER)
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "2", "None", "None"]


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_near_dedup_stage_equals_brute_force_between_80_and_85(spark):
    # A copy with its last d of 96 shingles replaced has a similarity of (96 - d) / (96 + d).
    rows, expected = [], set()
    for k in range(30):
        base, d = prose(k, 100), 5 + k % 9
        copy = [*base[: 100 - d], *(f"new{k}x{i}" for i in range(d))]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
        a, b = (shingle_set(r[1]) for r in rows[-2:])
        expected |= {2 * k} | ({2 * k + 1} if 100 * len(a & b) < 80 * len(a | b) else set())
    between = [k for k in range(30) if 80 <= 100 * (96 - (5 + k % 9)) / (96 + 5 + k % 9) < 85]
    assert len(between) >= 6
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs(spark, rows), FOLDER)
    assert {r.doc_id for r in got.collect()} == expected


def test_bands_follow_the_limit():
    assert banding(85, 100) == (25, 5) and banding(80, 100) == (31, 4)
    for part in (20, 50, 70, 80, 90, 95):
        n, rows = banding(part, 100)
        assert (1 - (part / 100) ** rows) ** n <= 1e-6 and n * rows <= 127


def test_near_dedup_stage_keeps_other_texts_of_an_id(spark):
    one, other = " ".join(prose(1, 60)), " ".join(prose(2, 60))
    rows = [(3, one), (5, one), (5, other), (7, f"{other} end"), (8, f"{one} end"), (8, one.upper())]
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs(spark, rows), FOLDER)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(3, one), (5, other)]
