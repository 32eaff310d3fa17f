import numpy as np

from newsflow.llm import components as rounds
from newsflow.llm.components import components
from newsflow.llm import near_dedup
from newsflow.llm.near_dedup import SLOTS, _cells, _intersections, bands, near_duplicates, shingles, superminhash
from newsflow.llm.words import SPACED, Words

from .helpers import docs, edited, prose


def brute_force(rows):
    sets = {}
    for doc, text in rows:
        words = (text or "").lower().split()
        sets[doc] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def test_components_of_links(spark):
    rows = []
    for k in range(60):
        base = prose(k % 6, 120 + k)
        rows.append((k, " ".join(edited(base[: 120 + k % 3], 150 if k % 2 else 60, k))))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "ONE  two"), (105, "one two three"), (106, rows[5][1]), (107, rows[5][1].upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_force(rows)
    assert got[104][1] == 103 and got[101] == (0, 101, True)


def test_links_that_no_star_finds(spark):
    # The smallest document of the bucket is linked to none of two others that are linked to each other.
    base = prose(1, 200)
    away = edited(base, 14, 5)
    rows = [(0, " ".join(base)), (1, " ".join(away)), (2, " ".join([*away[:-1], "end"])), (3, " ".join(edited(base, 13, 9)))]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_force(rows)
    assert got[2][1] == 1


def test_many_near_copies(spark):
    base = prose(2, 150)
    rows = [(k, " ".join(edited(base, 10 + k % 90, k))) for k in range(700)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_force(rows)


def test_rows_without_id_and_repeated(spark):
    text = " ".join(prose(4, 50))
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_duplicates(docs(spark, [(None, text), (3, text), (3, text), (8, text)])).collect())
    assert got == [("3", 3, True), ("3", 3, True), ("8", 3, False), ("None", None, True)]


def test_empty(spark):
    assert near_duplicates(docs(spark, [])).collect() == []


def test_signature_estimates_similarity():
    texts = [" ".join(edited(prose(k, 300), 40, s)).encode() for k in range(40) for s in (1, 2)]
    text, hashed = shingles(Words(texts, SPACED, lower=True), 5)
    signature = superminhash(text, hashed, len(texts))
    error = []
    for k in range(0, len(texts), 2):
        a, b = (set(hashed[text == i].tolist()) for i in (k, k + 1))
        error.append((signature[k] == signature[k + 1]).mean() - len(a & b) / len(a | b))
    assert abs(np.mean(error)) < 0.03 and np.std(error) < 0.06
    assert bands(signature).shape == (80, 25)


def test_signature_of_small_sets_fills_all_slots():
    text, hashed = shingles(Words([b"one", b"", b"one two three four five six"], SPACED, lower=True), 5)
    signature = superminhash(text, hashed, 3)
    assert signature.shape == (3, SLOTS)
    assert (signature[[0, 2]] < np.iinfo(np.uint64).max).all() and (signature[1] == np.iinfo(np.uint64).max).all()
    # one element visits every slot once
    assert sorted((signature[0] >> np.uint64(56)).tolist()) == list(range(SLOTS))


def test_intersections():
    sets = [np.array(sorted(s), np.uint64) for s in ({1, 2, 3}, {2, 3, 4}, {9}, set(), {1, 2, 3, 4, 9})]
    got = _intersections(sets, width=2)
    assert got[0, 1] == 2 and got[0, 4] == 3 and got[2, 4] == 1 and got[3].sum() == 0


def test_chain_and_star_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}}


def stored_tables(monkeypatch, module):
    """Plans of what ``module`` stores from now on."""
    plans, store = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label, *by: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or store(df, label, *by))
    return plans


def test_stars_need_no_round_and_rounds_of_few_links_no_shuffled_join(spark, monkeypatch):
    plans = stored_tables(monkeypatch, rounds)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = [(0, k) for k in range(1, 30)] + [(k, 50) for k in range(51, 60)]
        got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {**{k: 0 for k in range(1, 30)}, **{k: 50 for k in range(51, 60)}} and len(plans) == 1
        chain = spark.createDataFrame([(k, k + 1) for k in range(9)], "a long, b long")
        few = {r.id: r.component for r in components(chain).collect()}
        assert len(plans) > 2 and not any("SortMergeJoin" in plan for _, plan in plans)
        monkeypatch.setattr(rounds, "BROADCAST_LINKS", 0)
        assert {r.id: r.component for r in components(chain).collect()} == few == {k: 0 for k in range(1, 10)}
        assert "SortMergeJoin" in plans[-1][1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_are_found_once_where_no_link_is_missing(spark, monkeypatch):
    base = prose(4, 150)
    calls, found = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda links: calls.append(1) or found(links))
    rows = [(k, " ".join(edited(base, 140, k))) for k in range(8)] + [(20, "one two")]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()} == brute_force(rows)
    assert len(calls) == 1


def test_repeated_ids_are_judged_by_their_own_text(spark):
    a, b = prose(11, 80), prose(12, 80)
    rows = [(3, " ".join(a)), (5, " ".join([*a, "end"])), (5, " ".join(b)), (9, " ".join([*b, "end"])), (4, " ".join([*a, "stop"])), (4, " ".join([*a, "halt"]))]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect())
    assert got == [(3, 3, True), (4, 3, False), (4, 3, False), (5, 3, False), (5, 5, True), (9, 5, False)]


def test_cells_hold_all_pairs_of_different_components_and_no_more_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    # bucket: component of each member; the pivot is 0 everywhere
    buckets = {1: [0] * 500 + [7, 7, 8, 9], 2: [5] * 20 + [6] * 20 + [7] * 3, 3: [4] * 30, 4: [1, 2], 5: list(range(40))}
    rows = [(b, 1000 * b, 1000 * b + k, c) for b, components_ in buckets.items() for k, c in enumerate([0, *components_])]
    got = _cells(spark.createDataFrame(rows, "bucket long, pivot long, node long, component long")).collect()
    cells, sent = {}, {}
    for r in got:
        cells.setdefault((r.bucket, r.low, r.high), []).append((r.id, r.component))
        sent[r.bucket] = sent.get(r.bucket, 0) + 1
    met = {frozenset((x, y)) for members in cells.values() for x, cx in members for y, cy in members if cx != cy}
    wanted = {frozenset((1000 * b + i + 1, 1000 * b + j + 1)) for b, cs in buckets.items() for i, x in enumerate(cs) for j, y in enumerate(cs) if x != y}
    assert met == wanted
    # One text of each of the 500 members, and the others once per block of them; a bucket of one component sends nothing.
    assert sent[1] == 500 + 4 * 63 and 3 not in sent and sent[4] == 2


def test_many_copies_in_two_groups_and_some_between(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    one = prose(21, 150)
    two = edited(one, 9, 3)
    rows = [(k, " ".join(edited(one, 60, k))) for k in range(0, 300, 2)] + [(k, " ".join(edited(two, 60, k))) for k in range(1, 120, 2)]
    rows += [(400 + k, " ".join([w if k % 7 > i % 7 else v for i, (v, w) in enumerate(zip(one, two, strict=True))])) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_force(rows)
