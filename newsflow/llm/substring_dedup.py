"""Substring dedup: passages that already occur in an earlier document lose their words there.

A window is ``width`` consecutive words. Difference-cover anchors find the shared ones: with a cover of the residues
modulo PERIOD, any two occurrences of a text of at least anchor + PERIOD - 1 words hold a common anchor (ANCHOR words)
that starts at cover positions in both, however the occurrences are aligned. So

1. anchors at cover positions only (3 of 7) are hashed, and those that two documents share are found;
2. around them the match is extended: windows that hold a shared anchor are hashed to 128 bits, and the smallest
   document of each is found;
3. the words of all windows that start in a smaller document go.

Documents are dealt to groups by a hash of their id. A group sends each distinct hash once to the bucket of that hash,
as packed arrays, and the bucket answers with one bit per hash. So a passage that a third of all documents share is
one entry per group, texts are shuffled once (Spark reuses that exchange in all three steps), and groups and buckets
grow in number with the input, not in size.

Defined cases: null and empty texts have no words. A row without doc_id keeps all its words and counts for no other. Rows
that repeat a doc_id are one document as owners of windows, and each returns its own row. Empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import text_bytes
from newsflow.llm.words import SPACED, U, Words, chunks, covered, mix

PERIOD, COVER = 7, (1, 2, 4)  # every residue modulo 7 is a difference of two cover members
GROUP_BYTES = 8 << 20
LEAST_GROUPS = 24
BUCKET_BYTES = 16 << 20

_ASK = "bucket int, grp int, kind int, keys binary, low binary, high binary"
_ANSWER = "grp int, bucket int, kind int, bits binary"


def anchor_words(width: int) -> int:
    """Longest anchor that every shared window is sure to hold at a cover position of both sides."""
    return width - PERIOD + 1


def _runs(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class _Group:
    """All words of one group of documents, chunk by chunk."""

    def __init__(self, table: pa.Table, width: int):
        self.width = width
        self.ids = table["doc_id"].to_numpy(zero_copy_only=False) if table["doc_id"].null_count == 0 else None
        if self.ids is None:
            raise ValueError("rows without doc_id are set apart before grouping")
        self.anchors, self.anchor_doc, self.windows, self.window_doc = [], [], [], []
        size = anchor_words(width)
        self.parts = []
        for part, texts in chunks(table):
            words = Words(texts, SPACED, lower=False)
            place = np.arange(len(words.hash)) - words.first[words.text]
            at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (words.left >= size))
            self.parts.append((part, words, at, words.windows(size)[at]))

    def anchor_rows(self) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.concatenate([p[3] for p in self.parts]) if self.parts else np.zeros(0, U)
        docs = np.concatenate([self.ids[p[0]][p[1].text[p[2]]] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        return hashes, docs

    def window_rows(self, shared: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Per chunk: positions of the windows that hold a shared anchor."""
        size = anchor_words(self.width)
        for k, (_, words, at, hashes) in enumerate(self.parts):
            hit = at[_member(hashes, shared)]
            # a window from position p holds the anchors at p .. p + width - size
            steps = np.zeros(len(words.hash) + 2, np.int32)
            reach = self.width - size
            np.add.at(steps, np.maximum(hit - reach, words.first[words.text[hit]]), 1)
            np.add.at(steps, hit + 1, -1)
            yield k, np.flatnonzero((np.cumsum(steps)[: len(words.hash)] > 0) & (words.left >= self.width))


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the top bits, so that sorted keys are sorted by bucket."""
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int32)


def _distinct_anchors(group: _Group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct anchor hashes of a group, with the smallest and the largest document of each."""
    hashes, docs = group.anchor_rows()
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    at = _runs(hashes)
    return (hashes[at], np.minimum.reduceat(docs, at), np.maximum.reduceat(docs, at)) if len(at) else (hashes, docs, docs)


def _ask_anchors(width: int, buckets: int):
    """One row per bucket: 32 bits of each distinct anchor hash (the bucket holds more), and if two documents here share it.

    Buckets only tell whether another group has the same bits. A chance match costs some needless windows in step 2.
    """

    def run(table: pa.Table) -> pa.Table:
        keys, first, last = _distinct_anchors(_Group(table, width))
        bucket, grp = _bucket_of(keys, buckets), table["grp"][0].as_py()
        rows = [(int(bucket[a]), grp, 1, _short(keys[a:b]).tobytes(), np.packbits(first[a:b] != last[a:b]).tobytes(), b"") for a, b in _slices(bucket)]
        return _table(rows, _ASK_SCHEMA)

    return run


def _short(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 3) >> U(32)).astype(np.uint32)


def _slices(ordered: np.ndarray) -> list[tuple[int, int]]:
    at = _runs(ordered)
    return list(zip(at.tolist(), [*at[1:].tolist(), len(ordered)], strict=True)) if len(ordered) else []


_ASK_SCHEMA = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
_ANSWER_SCHEMA = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("bits", pa.binary())])
_RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _answer_anchors(table: pa.Table) -> pa.Table:
    """For each group in a bucket: which of its anchors another group or a second document of its own holds."""
    grps, keys, low = (table[c].to_pylist() for c in ("grp", "keys", "low"))
    arrays = [np.frombuffer(k, np.uint32) for k in keys]
    sizes = [len(a) for a in arrays]
    # Within a group, distinct hashes may share their 32 bits: that too counts as a match, and costs a few windows.
    together = np.concatenate(arrays)
    order = np.argsort(together, kind="stable")
    ordered = together[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(ordered), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    shared = np.empty(len(ordered), bool)
    shared[order] = twice
    rows, bucket = [], table["bucket"][0].as_py()
    for grp, own, part in zip(grps, low, np.split(shared, np.cumsum(sizes)[:-1]), strict=True):
        rows.append((grp, bucket, 1, np.packbits(part | np.unpackbits(np.frombuffer(own, np.uint8), count=len(part)).astype(bool)).tobytes()))
    return _table(rows, _ANSWER_SCHEMA)


def _bits(answers: pa.Table, kind: int, bucket: np.ndarray) -> np.ndarray:
    """The answers of one kind, put together in the order of the keys that were sent."""
    found = {b: bits for b, k, bits in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "bits")), strict=True) if k == kind}
    out = np.zeros(len(bucket), bool)
    for a, b in _slices(bucket):
        out[a:b] = np.unpackbits(np.frombuffer(found[int(bucket[a])], np.uint8), count=b - a).astype(bool)
    return out


class _Windows:
    """Distinct extended windows of a group, sorted by hash, and where each occurs."""

    def __init__(self, group: _Group, answers: pa.Table, buckets: int):
        keys = _distinct_anchors(group)[0]
        shared = keys[_bits(answers, 1, _bucket_of(keys, buckets))]
        high, low, docs, part, place = [np.zeros(0, U)], [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k, at in group.window_rows(shared):
            rows, words = group.parts[k][:2]
            high.append(words.windows(group.width)[at])
            low.append(words.windows(group.width, 1)[at])
            docs.append(group.ids[rows][words.text[at]])
            part.append(np.full(len(at), k, np.int32))
            place.append(at)
        self.high, self.low, self.docs, self.part, self.place = map(np.concatenate, (high, low, docs, part, place))
        order = np.lexsort((self.low, self.high))
        self.high, self.low, self.docs, self.part, self.place = (x[order] for x in (self.high, self.low, self.docs, self.part, self.place))
        new = np.ones(len(order), bool)
        new[1:] = (self.high[1:] != self.high[:-1]) | (self.low[1:] != self.low[:-1])
        self.at, self.number = np.flatnonzero(new), np.cumsum(new) - 1
        self.owner = np.minimum.reduceat(self.docs, self.at) if len(self.at) else self.docs


def _ask_windows(width: int, buckets: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _ASK_SCHEMA)
        found = _Windows(_Group(texts, width), answers, buckets)
        high, low = found.high[found.at], found.low[found.at]
        bucket, grp = _bucket_of(high, buckets), texts["grp"][0].as_py()
        rows = [(int(bucket[a]), grp, 2, high[a:b].tobytes(), low[a:b].tobytes(), found.owner[a:b].tobytes()) for a, b in _slices(bucket)]
        return _table(rows, _ASK_SCHEMA)

    return run


def _answer_windows(table: pa.Table) -> pa.Table:
    """For each group in a bucket: which of its windows start in a document smaller than all of the group that hold it."""
    grps = table["grp"].to_pylist()
    parts = [[np.frombuffer(x, t) for x in table[c].to_pylist()] for c, t in (("keys", U), ("low", U), ("high", np.int64))]
    high, low, owner = (np.concatenate(p) for p in parts)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    least = np.minimum.reduceat(owner[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = least < owner[order]
    bucket = table["bucket"][0].as_py()
    split = np.split(earlier, np.cumsum([len(p) for p in parts[0]])[:-1])
    return _table([(grp, bucket, 2, np.packbits(part).tobytes()) for grp, part in zip(grps, split, strict=True)], _ANSWER_SCHEMA)


def _remove(width: int, buckets: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _RESULT_SCHEMA)
        group = _Group(texts, width)
        found = _Windows(group, answers, buckets)
        earlier = _bits(answers, 2, _bucket_of(found.high[found.at], buckets))
        gone = earlier[found.number] | (found.owner[found.number] < found.docs)
        rows = []
        for k, (part, words, _, _) in enumerate(group.parts):
            drop = covered(found.place[gone & (found.part == k)], width, len(words.hash))
            n_removed = np.add.reduceat(np.append(drop, False).astype(np.int64), words.first) * (words.count > 0) if len(words.first) else []
            data = words.data.tobytes()
            for i, doc in enumerate(group.ids[part].tolist()):
                a, n = int(words.first[i]), int(words.count[i])
                kept = np.flatnonzero(~drop[a : a + n]) + a
                text = b" ".join([data[s:e] for s, e in zip(words.begin[kept].tolist(), words.end[kept].tolist(), strict=True)])
                rows.append((doc, n, int(n_removed[i]), text.decode()))
        return _table(rows, _RESULT_SCHEMA)

    return run


def remove_repeated_passages(docs: DataFrame, width: int = 13) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the kept words joined by one space as ``text``."""
    size = text_bytes(docs)
    groups = max(LEAST_GROUPS, -(-size // GROUP_BYTES))
    buckets = max(8, -(-3 * size // BUCKET_BYTES))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    grp = F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int")
    dealt = texts.filter("doc_id IS NOT NULL").select(grp.alias("grp"), "doc_id", "text").repartition(2 * groups, "grp")
    by_group = dealt.groupBy("grp")

    anchors = by_group.applyInArrow(_ask_anchors(width, buckets), _ASK)
    one = anchors.groupBy("bucket").applyInArrow(_answer_anchors, _ANSWER)
    windows = by_group.cogroup(one.groupBy("grp")).applyInArrow(_ask_windows(width, buckets), _ASK)
    two = windows.groupBy("bucket").applyInArrow(_answer_windows, _ANSWER)
    done = by_group.cogroup(one.union(two).groupBy("grp")).applyInArrow(_remove(width, buckets), "doc_id long, n_words long, n_removed long, text string")

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    loose = texts.filter("doc_id IS NULL").select("doc_id", F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    return done.union(loose.select("doc_id", F.size("words").cast("long"), F.lit(0).cast("long"), F.array_join("words", " ")))
