"""MinHash near-dedup with SuperMinHash signatures.

Every text becomes the set of its word shingles. In a SuperMinHash signature each element visits the slots in the
order of its own pseudo-random permutation and offers visit number + fraction, so a slot keeps the element that came
to it earliest. The ranks of one element are correlated, which lowers the variance against independent hashes, and a
text is finished as soon as every slot holds an offer from an earlier visit than the next one.

Documents with equal sets form classes first. Class representatives meet in LSH buckets (bands of signature slots,
as long as the limit allows).
Each bucket is linked as a star to its smallest member; members that are still in different components are then
compared inside tasks, block by block, those outside the bucket's largest component with all others, so a group of copies
never becomes rows of all its pairs.
Every candidate is verified on full sets, rebuilt from the texts. Components of verified links come from star contraction.

Defined cases: a text without words (or null) has an empty set and is linked with nothing; a text of fewer words than a
shingle is one shingle. A row without doc_id takes no part and has a null component. Rows that repeat a doc_id are
each judged by their own text: of a component the smallest (doc_id, hash of the text) is kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.components import components
from newsflow.llm.tables import broadcast_up_to, materialize
from newsflow.llm.words import SPACED, Words, chunks, mix

U = np.uint64
SLOTS = 127  # prime, so that (a + j * b) mod SLOTS is a permutation for every step b
BANDS, ROWS = 25, 5  # of the limit 0.85, see banding()
MISSED = 1e-6  # at most, probability that a pair at the limit shares no band
BROADCAST_ROWS = 500_000
FAN = 256  # members verified against one pivot in one group
BLOCK = 512  # members of one bucket that are compared in one group


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each text's distinct ``n``-word shingles, in that order."""
    at = words.left >= n
    texts, hashes = [words.text[at]], [words.windows(n)[at]]
    for size in range(1, n):
        short = np.flatnonzero(words.count == size)
        if len(short):
            texts.append(short)
            hashes.append(words.windows(size)[words.first[short]])
    text, hashed = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])
    return text[new], hashed[new]


def superminhash(text: np.ndarray, hashed: np.ndarray, n_texts: int) -> np.ndarray:
    """(n_texts, SLOTS) signatures; rows of texts without elements stay at the maximum."""
    out = np.full(n_texts * SLOTS, np.iinfo(U).max, U)
    place = (mix(hashed, 21) % U(SLOTS)).astype(np.int64)
    step = (mix(hashed, 22) % U(SLOTS - 1)).astype(np.int64) + 1
    base = text.astype(np.int64) * SLOTS
    for visit in range(SLOTS):
        if not len(hashed):
            break
        offer = (mix(hashed, 32 + visit) >> U(8)) | U(visit << 56)
        np.minimum.at(out, base + place, offer)
        filled = out.reshape(n_texts, SLOTS).max(axis=1) < U((visit + 1) << 56)
        on = ~filled[base // SLOTS]
        hashed, base, place, step = hashed[on], base[on], place[on], step[on]
        place = (place + step) % SLOTS
    return out.reshape(n_texts, SLOTS)


def banding(part: int, whole: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that a pair at the limit ``part / whole`` misses with probability MISSED at most.

    25 of 5 at 0.85 (4e-7), 31 of 4 at 0.8 (8e-8). Limits below about 0.103 get one row and are missed more often.
    """
    fits = [r for r in range(2, SLOTS + 1) if (1 - (part / whole) ** r) ** (SLOTS // r) <= MISSED]
    rows = max(fits, default=1)
    return SLOTS // rows, rows


def bands(signatures: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(n_texts, n_bands) hashes of ``rows`` slots each."""
    cells = signatures[:, : n_bands * rows].reshape(-1, n_bands, rows)
    out = np.broadcast_to(np.arange(n_bands, dtype=U), cells.shape[:2])
    for k in range(rows):
        out = mix(out ^ cells[:, :, k])
    return out


def version() -> Column:
    """Hash of a row's text, which tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


_SIGNED = "doc_id long, version long, n_shingles long, s1 long, s2 long, sig binary, bands array<long>"


def _sign(n: int, n_bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                text, hashed = shingles(Words(texts, SPACED, lower=True), n)
                size = np.bincount(text, minlength=len(texts))
                some = np.flatnonzero(size)
                sums = np.zeros((2, len(texts)), U)
                if len(some):
                    at = np.concatenate([[0], np.cumsum(size[some])[:-1]])
                    for k in range(2):
                        sums[k, some] = np.add.reduceat(mix(hashed, 11 + k), at)
                signature = superminhash(text, hashed, len(texts))
                banded = pa.FixedSizeListArray.from_arrays(pa.array(bands(signature, n_bands, rows).view(np.int64).ravel()), n_bands)
                low = signature.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].slice(part.start, part.stop - part.start) for c in ("doc_id", "version")),
                        pa.array(size.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.array([row.tobytes() for row in low], pa.binary()),
                        banded.cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "version", "n_shingles", "s1", "s2", "sig", "bands"],
                )

    return run


def sign(docs: DataFrame, n: int = 5, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: size of the shingle set, its 128-bit fingerprint, low bytes of the signature and band hashes."""
    return docs.select("doc_id", version().alias("version"), F.col("text").cast("string")).mapInArrow(_sign(n, n_bands, rows), _SIGNED)


def _close(least: int):
    """Keep candidate pairs whose signatures agree in at least ``least`` slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, SLOTS) for c in ("sig_x", "sig_y"))
                keep = (x == y).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch[c].filter(pa.array(keep)) for c in ("x", "y")], names=["x", "y"])

    return run


def _least_equal(part: int, whole: int) -> int:
    """Five deviations below the slots that agree at the limit similarity: a real link is missed once in 3 million."""
    p = part / whole
    return int(SLOTS * p - 5 * (SLOTS * p * (1 - p)) ** 0.5)


def _verifier(n: int, part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pivots = None, []
        for batch in batches:
            for rows, texts in chunks(batch):
                text, hashed = shingles(Words(texts, SPACED, lower=True), n)
                at = np.searchsorted(text, np.arange(len(texts) + 1))
                x, salt, ids = (batch[c].slice(rows.start, rows.stop - rows.start).to_pylist() for c in ("x", "salt", "id"))
                found: list[tuple[int, int]] = []
                for i, key in enumerate(zip(x, salt, strict=True)):
                    own = hashed[at[i] : at[i + 1]]
                    if key != group:
                        group, pivots = key, []
                    if ids[i] == key[0]:
                        pivots.append(own.copy())
                        continue
                    for pivot in pivots:
                        both = len(np.intersect1d(pivot, own, assume_unique=True))
                        if both and whole * both >= part * (len(pivot) + len(own) - both):
                            found.append((key[0], ids[i]))
                            break
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _texts_of(asked: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """``asked`` with the text of the class ``id``: that of the row which stands for it, not of others with its doc_id."""
    rows = reps.select(F.col("node").alias("id"), F.col("rep").alias("doc_id"), "version")
    stored = broadcast_up_to(materialize(asked.join(rows, "id"), "asked"), BROADCAST_ROWS)
    return docs.select("doc_id", version().alias("version"), "text").join(stored, ["doc_id", "version"])


def verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    """The (x, y) pairs whose full shingle sets reach ``part / whole``. Texts travel to their pivots x, hot pivots in parts."""
    fans = pairs.groupBy("x").agg(F.ceil(F.count("*") / FAN).cast("int").alias("fans"))
    salt = F.pmod(F.xxhash64("y"), "fans").cast("int").alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("salt")
    members = pairs.join(fans, "x").select("x", salt, F.lit(1).alias("role"), F.col("y").alias("id"))
    pivots = fans.select("x", every, F.lit(0).alias("role"), F.col("x").alias("id"))
    return (
        _texts_of(members.union(pivots), reps, docs)
        .select("x", "salt", "role", "id", "text")
        .repartition("x", "salt")
        .sortWithinPartitions("x", "salt", "role", "id")
        .mapInArrow(_verifier(n, part, whole), "a long, b long")
    )


def _candidates(pairs: DataFrame, reps: DataFrame, part: int, whole: int) -> DataFrame:
    """Of distinct (x, y) pairs those that set sizes and signatures allow to be links."""
    of = lambda c: reps.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    sized = pairs.join(of("x"), "x").join(of("y"), "y").filter(whole * F.least("n_x", "n_y") >= part * F.greatest("n_x", "n_y"))
    return sized.select("x", "y", "sig_x", "sig_y").mapInArrow(_close(_least_equal(part, whole)), "x long, y long")


def near_duplicates(docs: DataFrame, n: int = 5, part: int = 85, whole: int = 100) -> DataFrame:
    """Per row of ``docs``: doc_id, version (hash of the text), n_shingles, component_id and kept.

    Two rows are linked if ``whole * |A & B| >= part * |A | B|``. A component keeps its smallest (doc_id, version), and
    component_id is that doc_id. Jobs run while this is called.
    """
    signed = materialize(sign(docs, n, *banding(part, whole)), "signed")
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("n_shingles", "s1", "s2").agg(
        F.min(F.struct("doc_id", "version")).alias("first"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands")
    )
    # A doc_id may stand for several classes, so classes have numbers of their own, which are stored before they are used.
    numbered = classes.select("*", F.col("first.doc_id").alias("rep"), "first.version", F.monotonically_increasing_id().alias("node")).drop("first")
    reps = materialize(numbered, "classes")
    members = reps.select("node", F.explode("bands").alias("bucket"))
    stars = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot < last")
    met = materialize(members.join(stars.select("bucket", "pivot"), "bucket"), "met")
    star = met.filter("pivot < node").select(F.col("pivot").alias("x"), F.col("node").alias("y")).distinct()
    links = materialize(verify(materialize(_candidates(star, reps, part, whole), "pairs"), reps, docs, n, part, whole), "verified")
    joined = components(links)

    component = F.coalesce("component", "node").alias("component")
    labelled = met.join(joined, met["node"] == joined["id"], "left").select("bucket", "pivot", "node", component)
    more = materialize(_cross_links(materialize(labelled, "labelled"), reps, docs, n, part, whole), "verified")
    # The components found stand for their links: each is a star already.
    final = (joined if more.isEmpty() else components(joined.union(more))).select(F.col("id").alias("node"), "component")

    # Only components of several classes are looked up; the class that names one is not in ``final`` itself.
    several = final.union(final.select(F.col("component").alias("node"), "component").distinct())
    first = several.join(reps.select("node", "rep", "version"), "node").groupBy("component").agg(F.min(F.struct("rep", "version")).alias("first"))
    firsts = broadcast_up_to(materialize(first, "firsts"), BROADCAST_ROWS)
    of_node = materialize(several.join(firsts, "component").select("node", "first"), "first-of-class")
    of_rep = reps.select("n_shingles", "s1", "s2", "node", F.struct("rep", "version").alias("own")).join(of_node, "node", "left")
    of_class = of_rep.select("n_shingles", "s1", "s2", F.coalesce("first", "own").alias("first"))
    taking_part = F.col("doc_id").isNotNull()
    return (
        signed.select("doc_id", "version", "n_shingles", "s1", "s2")
        .join(of_class, ["n_shingles", "s1", "s2"], "left")
        .select(
            "doc_id",
            "version",
            "n_shingles",
            F.when(taking_part, F.coalesce("first.rep", "doc_id")).alias("component_id"),
            (~taking_part | F.col("first").isNull() | ((F.col("doc_id") == F.col("first.rep")) & (F.col("version") == F.col("first.version")))).alias("kept"),
        )
        .withColumn("kept", F.coalesce("kept", F.lit(True)))
    )


def _cross_links(labelled: DataFrame, reps: DataFrame, docs: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    """Links within a bucket between different components. Pairs with the pivot are judged already."""
    return (
        _texts_of(_cells(labelled), reps, docs)
        .select("bucket", "low", "high", "id", "component", "text")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high", "id")
        .mapInArrow(_cross_verifier(n, part, whole), "a long, b long")
    )


def _cells(labelled: DataFrame) -> DataFrame:
    """(bucket, low, high, id, component): the members that are compared with each other, by cell.

    Buckets with the same members are taken once. The members of a bucket's largest component are not compared among
    themselves: they meet only the others, each in as many cells as there are blocks of others, mostly one. The others meet
    each other and them, so any two of different components share a cell. A cell holds two blocks, one task compares
    it and returns at most one link per member. Texts sent grow with the bucket times the number of blocks of others.
    """
    rows = labelled.filter("node <> pivot")
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"))
    largest = F.max(F.struct("n", "component")).alias("largest")
    buckets = sizes.groupBy("bucket").agg(largest, F.sum("n").alias("n"), F.sum("same").alias("same")).filter("largest.n < n")
    open_ = buckets.groupBy("same", "n").agg(F.min(F.struct("bucket", "largest")).alias("first"))
    blocks = open_.select(
        "first.bucket",
        F.col("first.largest.component").alias("main"),
        F.ceil(F.col("first.largest.n") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("first.largest.n")) / BLOCK).cast("int").alias("other_blocks"),
    )
    hashed, in_main = F.xxhash64("node"), F.col("component") == F.col("main")
    block = F.when(in_main, F.col("other_blocks") + F.pmod(hashed, "main_blocks")).otherwise(F.pmod(hashed, "other_blocks")).cast("int")
    placed = rows.join(blocks, "bucket").withColumn("block", block)
    met = F.sequence(F.lit(0), F.col("other_blocks") + F.when(in_main, 0).otherwise(F.col("main_blocks")) - 1)
    # The pairs within a block of others are compared in each of its cells with another block.
    cells = F.transform(F.filter(met, lambda o: o != F.col("block")), lambda o: F.struct(F.least("block", o).alias("low"), F.greatest("block", o).alias("high")))
    return placed.select("bucket", F.explode(cells).alias("cell"), F.col("node").alias("id"), "component").select("bucket", "cell.low", "cell.high", "id", "component")


def _cross_verifier(n: int, part: int, whole: int):
    def links(members: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int]]:
        ids, component = [m[0] for m in members], np.array([m[1] for m in members])
        size = np.array([len(m[2]) for m in members])
        both = _intersections([m[2] for m in members])
        linked = (whole * both >= part * (size[:, None] + size[None, :] - both)) & (component[:, None] != component[None, :])
        # One link for each two components that meet is enough; labels move along as components join.
        for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
            if component[i] != component[j]:
                component[component == component[j]] = component[i]
                yield ids[i], ids[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, []

        def done(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for rows, texts in chunks(batch):
                text, hashed = shingles(Words(texts, SPACED, lower=True), n)
                at = np.searchsorted(text, np.arange(len(texts) + 1))
                keys, ids, component = ([batch[c].slice(rows.start, rows.stop - rows.start).to_pylist() for c in cs] for cs in (("bucket", "low", "high"), ("id",), ("component",)))
                found: list[tuple[int, int]] = []
                for i, key in enumerate(zip(*keys, strict=True)):
                    if key != group:
                        found += links(members)
                        group, members = key, []
                    members.append((ids[0][i], component[0][i], hashed[at[i] : at[i + 1]].copy()))
                yield done(found)
        yield done(list(links(members)))

    return run


def _intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of sorted sets: products of 0/1 matrices over the elements that two sets share."""
    size = len(sets)
    both = np.zeros((size, size), np.int64)
    if size < 2:
        return both
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    on = shared[element]
    owner, element = owner[on], rank[element[on]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(element, (low, low + width))
        cells = np.zeros((size, width), np.float32)
        cells[owner[a:b], element[a:b] - low] = 1
        both += (cells @ cells.T).astype(np.int64)
    return both
