import hashlib
import random
import zlib
from math import fmod

import pytest

from newsflow.llm.conversation_trie import as_they_are, numbered_turns, prefix_trie, regrown

SCHEMA = "conv_id long, turn long, role string, text string, k long, grp string, at long, slice long, node string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", 2, 3, "n") for r in rows], SCHEMA)


def in_order(rows):
    def tie(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest())

    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=tie):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(fmod(c, 5)), [])[:h] + own[h:]
    return out


def by_hand(convs):
    """All nodes by their whole prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    rows = []
    for p, convs_of in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs_of if len(convs[c]) == len(p)))
        rows.append((min(convs_of), len(p), min(members[p[:-1]]) if p else None, len(convs_of), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, rows))


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(repr(tuple(r)) for r in frame.collect())


def sample(seed, n=120, longest=14):
    """Conversations that share beginnings, repeat each other, tie, and lack parts."""
    rng = random.Random(seed)
    rows, known = [], [[]]
    for c in range(-7, n):
        if rng.random() < 0.1:
            continue
        turns = list(rng.choice(known))
        turns = turns[: rng.randrange(len(turns) + 1)] if rng.random() < 0.5 else turns
        turns += [(rng.choice(["user", "bot", None]), rng.choice(["a", "é", "", None, "long text " * 5])) for _ in range(rng.randrange(longest - len(turns) + 1) if len(turns) < longest and rng.random() < 0.7 else 0)]
        known.append(turns)
        rows += [(c, None if k == 0 else k // 2 if c % 7 == 0 else k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(None, 0, "user", "a"), (200, 1, "user", "a"), (200, 1, "user", "a"), (201, 0, "us", "era"), (202, 0, "user", "a")]
    rows += [(300 + k, 0, "user", "common") for k in range(60)] + [(300 + k, 1, "bot", str(k % 2)) for k in range(50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,slices", [(256, 1), (256, 9), (1, 5), (2, 3), (3, 40)])
def test_trie_equals_all_prefixes(spark, block, slices):
    rows = sample(block + slices)
    convs = in_order(rows)
    frame = table(spark, rows)
    assert got(prefix_trie(*as_they_are(numbered_turns(frame)), block=block, slices=slices)) == by_hand(convs)


@pytest.mark.parametrize("block,slices", [(256, 4), (4, 6)])
def test_rebuilt_conversations(spark, block, slices):
    rows = sample(77, longest=20)
    grown = rebuilt(in_order(rows))
    assert any(not turns for turns in grown.values())
    assert got(prefix_trie(*regrown(numbered_turns(table(spark, rows))), block=block, slices=slices)) == by_hand(grown)


def test_one_long_conversation_and_copies_of_it(spark):
    rows = [(c, k, "user", f"t{k}" if k < 700 or c < 2 else f"{c}") for c in range(3) for k in range(800 - 5 * c)]
    rows += [(c, 0, "user", "t0") for c in range(10, 90)]
    assert got(prefix_trie(*as_they_are(numbered_turns(table(spark, rows))), slices=6)) == by_hand(in_order(rows))


def test_empty(spark):
    for rows in ([], [(None, 1, "user", "a")]):
        assert prefix_trie(*regrown(numbered_turns(table(spark, rows)))).collect() == []
