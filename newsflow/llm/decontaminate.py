"""Benchmark decontamination by winnowing.

Fingerprints of a text are the minimum ``K``-gram hashes of every ``WINDOW`` consecutive ones, so two texts that share
K + WINDOW - 1 words share a fingerprint. Fingerprints of documents and benchmark items are joined; each hit is then
extended: the windows of words around it are compared as 128-bit hashes with the windows of all items. An item with
fewer words than a window is one window of its own length, and its only fingerprint is the hash of that whole window.

Only hashes, ids and positions pass the joins. The benchmark side is broadcast up to ``BROADCAST_ROWS`` rows and
joined with a shuffle beyond. Texts are read again only for documents with a hit.

Defined cases: null and empty texts have no words and are clean. An item without words or without item_id matches nothing.
A document row without doc_id is judged like any other. Rows that repeat a doc_id are judged by their own text, rows that
repeat both get a result each; repeated item rows count once. Very long texts are many windows. Only A-Z is lower-cased. Empty tables give empty results, an empty benchmark only clean documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import ascii_lower, broadcast_up_to, materialize
from newsflow.llm.words import ALNUM, U, Words, chunks, mix

K = 6
BROADCAST_ROWS = 1_000_000


def fingerprints(grams: np.ndarray, valid: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Positions whose hash is the least of some ``window`` consecutive valid grams; equal ones are all taken.

    ``valid`` grams of one text are consecutive and begin at ``first``.
    """
    size = len(grams)
    if not size:
        return np.zeros(0, np.int64)
    top = np.iinfo(U).max
    value = np.where(valid, grams, top)
    # Valid starts of windows: all their grams are valid, thus of one text.
    run = np.zeros(size + 1, np.int64)
    run[1:] = np.cumsum(valid)
    starts = np.zeros(size, bool)
    if size >= window:
        starts[: size - window + 1] = valid[: size - window + 1] & (run[window:] - run[:-window] == window)
        starts[: size - window + 1] &= first[: size - window + 1] == first[window - 1 :]
    least = value.copy()
    for k in range(1, min(window, size)):
        np.minimum(least[: size - k], value[k:], out=least[: size - k])
    best = np.where(starts, least, U(0))
    cover = best.copy()
    for k in range(1, min(window, size)):
        np.maximum(cover[k:], best[: size - k], out=cover[k:])
    return np.flatnonzero(valid & (cover == value))


def _marks(words: Words, width: int, short: list[int], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, size, hash) of fingerprints: winnowed K-grams with size 0; and for each short size, the windows of that
    many words: everywhere in documents, only as the whole item in items."""
    grams = words.windows(K)
    at = fingerprints(grams, words.left >= K, words.first[words.text], width - K + 1)
    out = [(at, np.zeros(len(at), np.int32), grams[at])]
    for size in short:
        here = words.left >= size
        if whole:
            here &= (words.count[words.text] == size) & (np.arange(len(here)) == words.first[words.text])
        here = np.flatnonzero(here)
        out.append((here, np.full(len(here), size, np.int32), mix(words.windows(size)[here], size)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _document_marks(width: int, short: list[int]):
    """Per text one row with its number of words and no hash, and one row per fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                words = Words(texts, ALNUM, lower=True)
                at, size, hashed = _marks(words, width, short, whole=False)
                text = words.text[at]
                ids, version = (batch[c].slice(part.start, part.stop - part.start) for c in ("id", "version"))
                owner = pa.array(np.concatenate([np.arange(len(texts)), text]))
                blank = np.arange(len(owner)) < len(texts)
                fill = lambda x, t: pa.array(np.concatenate([np.zeros(len(texts), x.dtype), x]).astype(t), mask=blank)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(owner),
                        version.take(owner),
                        pa.array(np.concatenate([words.count, np.zeros(len(at), np.int64)]).astype(np.int64), mask=~blank),
                        fill(at - words.first[text], np.int32),
                        fill(size, np.int32),
                        fill(hashed.view(np.int64), np.int64),
                    ],
                    names=["id", "version", "n_words", "pos", "size", "hash"],
                )

    return run


def _item_marks(width: int, short: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch):
                _, size, hashed = _marks(Words(texts, ALNUM, lower=True), width, short, whole=True)
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(hashed.view(np.int64))], names=["size", "hash"])

    return run


def _item_windows(width: int):
    """(item_id, size, high, low) for every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                words = Words(texts, ALNUM, lower=True)
                ids = batch["item_id"].slice(part.start, part.stop - part.start)
                for size in range(1, width + 1):
                    at = words.left >= size
                    if size < width:
                        at &= (words.count[words.text] == size) & (np.arange(len(at)) == words.first[words.text])
                    if at.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array(words.text[at])),
                                pa.array(np.full(at.sum(), size, np.int32)),
                                pa.array(words.windows(size)[at].view(np.int64)),
                                pa.array(words.windows(size, 1)[at].view(np.int64)),
                            ],
                            names=["item_id", "size", "high", "low"],
                        )

    return run


def _document_windows(width: int):
    """(id, version, pos, size, high, low) of the windows around each hit: all that hold a K-gram hit, or the short one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                words = Words(texts, ALNUM, lower=True)
                ids, version, hits = (batch[c].slice(part.start, part.stop - part.start) for c in ("id", "version", "hits"))
                count = np.diff(hits.offsets.to_numpy())
                flat = hits.flatten()
                size, pos = (flat.field(c).to_numpy() for c in ("size", "pos"))
                text = np.repeat(np.arange(len(texts)), count)
                pos = pos + words.first[text]
                for each in np.unique(size):
                    at = pos[size == each]
                    if not each:
                        reach = width - K
                        at = np.unique(np.maximum(at[:, None] - np.arange(reach + 1), words.first[words.text[at]][:, None]).ravel())
                        at = at[words.left[at] >= width]
                    n = int(each) or width
                    owner = words.text[at]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(owner)),
                            version.take(pa.array(owner)),
                            pa.array((at - words.first[owner]).astype(np.int32)),
                            pa.array(np.full(len(at), n, np.int32)),
                            pa.array(words.windows(n)[at].view(np.int64)),
                            pa.array(words.windows(n, 1)[at].view(np.int64)),
                        ],
                        names=["id", "version", "pos", "size", "high", "low"],
                    )

    return run


def _short_sizes(items: DataFrame, width: int) -> list[int]:
    """The lengths below ``width`` that items have: at most ``width - 1`` numbers."""
    words = F.size(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")))
    found = items.select(words.alias("n")).filter((F.col("n") > 0) & (F.col("n") < width)).distinct()
    return sorted(r.n for r in found.collect())


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """Per row of ``docs``: id, version (hash of the text), n_words, n_hit, items (sorted list of item_ids as strings).

    A word is hit if it lies in an occurrence of a window of an item. Jobs run while this is called.
    """
    items = benchmark.filter("item_id IS NOT NULL").select("item_id", F.col("text").cast("string"))
    short = _short_sizes(items, width)
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), F.col("text").cast("string").alias("text"))

    marks = materialize(items.select("text").mapInArrow(_item_marks(width, short), "size int, hash long").distinct(), "item-marks")
    marked = texts.mapInArrow(_document_marks(width, short), "id long, version long, n_words long, pos int, size int, hash long")
    hit = marked.join(broadcast_up_to(marks.withColumn("known", F.lit(True)), BROADCAST_ROWS), ["size", "hash"], "left")
    per_doc = materialize(
        hit.filter("hash IS NULL OR known")
        .groupBy("id", "version")
        .agg(F.max("n_words").alias("n_words"), F.count_if(F.col("hash").isNull()).cast("int").alias("times"), F.collect_set(F.when(F.col("known"), F.struct("size", "pos"))).alias("hits")),
        "hits",
    )
    with_hits = broadcast_up_to(per_doc.filter(F.size("hits") > 0).select("id", "version", "hits"), BROADCAST_ROWS, "hits")
    same = texts["id"].eqNullSafe(with_hits["id"]) & (texts["version"] == with_hits["version"])
    windows = texts.join(with_hits, same).select(texts["id"], texts["version"], "text", "hits").mapInArrow(
        _document_windows(width), "id long, version long, pos int, size int, high long, low long"
    )
    known = materialize(
        items.mapInArrow(_item_windows(width), "item_id long, size int, high long, low long")
        .groupBy("size", "high", "low")
        .agg(F.collect_set("item_id").alias("items")),
        "item-windows",
    )
    found = windows.join(broadcast_up_to(known, BROADCAST_ROWS, "items"), ["size", "high", "low"])
    result = found.groupBy("id", "version").agg(
        F.collect_set(F.struct("pos", "size")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    ).select("id", "version", _union_length("spans").alias("n_hit"), F.array_sort(F.transform("items", lambda i: i.cast("string"))).alias("items"))
    # Rows that repeat both id and text are judged once and returned each.
    left = per_doc.select("id", "version", "n_words", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    join = left["id"].eqNullSafe(result["id"]) & (left["version"] == result["version"])
    return left.join(result, join, "left").select(
        left["id"], left["version"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _union_length(spans: str):
    """Words covered by (pos, size) windows, read in order of position."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))

    def step(acc, span):
        end = span["pos"] + span["size"]
        fresh = F.greatest(end - F.greatest(acc["end"], span["pos"]), F.lit(0))
        return F.struct((acc["total"] + fresh).alias("total"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["total"])


def contaminated(n_words, n_hit):
    """A text is contaminated if at least a twentieth of its words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
