"""Mixing documents to target weights of domains that are only known softly.

A classifier learned from a labelled table gives every document posterior probabilities of the domains. Each document then
gets a nonnegative rate (expected number of copies) such that the expected tokens per domain, the sum over documents of
rate x tokens x posterior, come as close to the targets as least squares allows. The fit is preconditioned projected gradient,
started at the same rate for all. Steps are taken per token, so a rate depends on the posterior alone and long texts
are not treated apart; a round is one aggregate of a few sums over a narrow table, and the driver keeps only the steps.

The classifier is softmax regression on hashed words and the text's shape. It is fitted on a bounded sample of labelled
documents (``SAMPLE_ROWS`` of those that are in the table, the first by a hash of the id); everything else covers all documents.

Defined cases: a null or empty text has no tokens, its rate follows its posterior like any other. Labels that are null
in id or domain are left out, of repeated ones the first domain by name counts. Without labels all domains are equally
likely. Repeated rows and rows without doc_id get the same rate for the same text; whole copies of rows without doc_id
are drawn by their text. Targets that cannot be reached are met as closely as possible, and ``gap`` tells how closely. Texts of
any length are whole; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import materialize
from newsflow.llm.words import SPACED, U, Words, chunks, mix

SAMPLE_ROWS = 3000
BINS = 2048
SHAPES = 5
CHUNK_ROWS = 256  # texts whose features are held at once, as a dense matrix
ROUNDS = 100  # a fit that has not ended by then warns
TOLERANCE = 1e-3  # of each target
STATIONARY = 1e-12  # square of the projected gradient, against its start
STALLED = 1e-7  # share of the squared distance that a round must take away


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(features, number of words) of texts: damped counts of hashed lower-case words, and what the text looks like."""
    words = Words(texts, SPACED, lower=True)
    n = len(texts)
    counts = np.bincount(words.text * BINS + (mix(words.hash, 2) % U(BINS)).astype(np.int64), minlength=n * BINS).reshape(n, BINS)
    raw = np.frombuffer(b" ".join([*(t or b"" for t in texts), b""]), np.uint8)
    per_text = lambda mask: np.add.reduceat(np.append(mask, False).astype(np.int64), words.start[:-1])
    size = np.maximum(np.diff(words.start) - 1, 1)
    total = np.maximum(words.count, 1)
    # distinct words of each text: the text's number above 44 bits of the word's hash
    kinds = (np.unique((words.text.astype(U) << U(44)) | (words.hash >> U(20))) >> U(44)).astype(np.int64)
    shape = np.stack(
        [
            per_text((raw >= 65) & (raw <= 90)) / size,
            per_text((raw >= 33) & (raw <= 64)) / size,
            np.bincount(kinds, minlength=n) / total,
            size / total / 10,
            np.log1p(words.count) / 10,
        ],
        axis=1,
    )
    damped = np.log1p(counts.astype(np.float32)) / np.sqrt(total)[:, None]
    return np.concatenate([damped, shape], axis=1).astype(np.float32), words.count


class Classifier:
    """Softmax regression on standardized features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, domains: tuple[str, ...]):
        self.mean, self.scale, self.weights, self.domains = mean, scale, weights, domains

    @classmethod
    def fit(cls, x: np.ndarray, domain: np.ndarray, domains: tuple[str, ...], rounds: int = 200, ridge: float = 1e-2) -> Classifier:
        """``domain``: index of each row's domain."""
        if not len(x):
            return cls(np.zeros(BINS + SHAPES), np.ones(BINS + SHAPES), np.zeros((BINS + SHAPES + 1, len(domains))), domains)
        mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        # One matrix, worked on in place: this runs in the driver.
        z = np.ones((len(x), x.shape[1] + 1), np.float32)
        own = z[:, :-1]
        np.subtract(x, mean, out=own)
        np.divide(own, scale, out=own)
        np.clip(own, -8, 8, out=own)
        wanted = np.eye(len(domains), dtype=np.float32)[domain]
        weights = np.zeros((z.shape[1], len(domains)), np.float32)
        ahead, before = weights, weights
        step = np.float32(1.0 / (0.5 * _largest_square(z) / len(z) + ridge))
        for k in range(rounds):
            gradient = z.T @ (_softmax(z @ ahead) - wanted) / len(z) + ridge * ahead
            before, weights = weights, ahead - step * gradient
            ahead = weights + np.float32(k / (k + 3)) * (weights - before)
        return cls(mean, scale, weights, domains)

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        """Rounded, so that a text gets the same ones in any chunk."""
        z = np.clip((x - self.mean) / self.scale, -8, 8).astype(np.float64)
        return np.round(_softmax(z @ self.weights[:-1].astype(np.float64) + self.weights[-1]), 9)


def _largest_square(z: np.ndarray) -> float:
    """Largest eigenvalue of z'z, from above by a few power steps."""
    v = np.ones(z.shape[1], np.float32)
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    return 1.1 * float(np.linalg.norm(z.T @ (z @ v)))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pack(x: np.ndarray) -> pa.RecordBatch:
    """Rows of features as the places and values that are not nil: most words of a text's row are."""
    at = [np.flatnonzero(row) for row in x]
    packed = [[k.astype(np.uint16).tobytes() for k in at], [row[k].tobytes() for row, k in zip(x, at, strict=True)]]
    return pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in packed], names=["at", "x"])


def _unpack(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for own, row in zip(out, rows, strict=True):
        own[np.frombuffer(row["at"], np.uint16)] = np.frombuffer(row["x"], np.float32)
    return out


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...], rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on at most ``rows`` distinct labelled texts of ``docs``, the first by a hash of the id; ``labels`` is (doc_id, domain)."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(*domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # Labels of other documents must not use up the sample.
    present = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = materialize(present.orderBy(*order).limit(rows), "sample-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, rows=CHUNK_ROWS):
                packed = _pack(features(texts)[0])
                yield pa.RecordBatch.from_arrays([batch["domain"].slice(part.start, len(texts)), *packed.columns], names=["domain", "at", "x"])

    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # Copies of a row, however many, are one row before anything leaves the cluster.
    versions = found.withColumn("version", F.xxhash64(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", "version"])
    sample = versions.orderBy(*order, "version").limit(rows).select("domain", "text").mapInArrow(run, "domain string, at binary, x binary").collect()
    return Classifier.fit(_unpack(sample, BINS + SHAPES), np.array([domains.index(r.domain) for r in sample], np.int64), domains)


def predict(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """Per row of ``docs``: doc_id, source, version (hash of the text), n_tokens and posteriors in the order of the domains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, rows=CHUNK_ROWS):
                x, count = features(texts)
                own = [batch[c].slice(part.start, len(texts)) for c in ("doc_id", "source", "version")]
                posterior = pa.array(list(classifier.posteriors(x).astype(np.float64)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*own, pa.array(count.astype(np.int64)), posterior], names=["doc_id", "source", "version", "n_tokens", "posterior"])

    wanted = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, source string, version long, n_tokens long, posterior array<double>")


def _rates(posterior: np.ndarray, start: float, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the steps: each is a change per domain, projected to rates that are not negative."""
    rate = np.full(len(posterior), start)
    for change in steps:
        rate = np.maximum(rate - posterior @ change, 0.0)
    return rate


def _posterior_matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch["posterior"].flatten().to_numpy().reshape(batch.num_rows, size)


def _sums(size: int, start: float, steps: list[np.ndarray], trials: list[np.ndarray], gradient: np.ndarray):
    """Per task one row: the projected gradient's square after the steps, and tokens x posterior x posterior of all documents;
    then for each further step that is tried, tokens per domain, and the same product of the documents with a rate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 + size * size + len(trials) * (size + size * size))
        for batch in batches:
            posterior, tokens = _posterior_matrix(batch, size), batch["n_tokens"].to_numpy().astype(np.float64)
            weighted = posterior * tokens[:, None]
            rate = _rates(posterior, start, steps)
            slope = posterior @ gradient
            parts = [[(tokens * np.where((rate > 0) | (slope < 0), slope, 0.0) ** 2).sum()], (weighted.T @ posterior).ravel()]
            for change in trials:
                moved = np.maximum(rate - posterior @ change, 0.0)
                free = moved > 0
                parts += [moved @ weighted, (weighted[free].T @ posterior[free]).ravel()]
            sums += np.concatenate(parts)
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

    return run


def _trials(free: np.ndarray, gradient: np.ndarray, limit: float) -> list[np.ndarray]:
    """Steps worth trying: the gradient scaled by the inverse of the documents' product matrix (more and less damped), plain
    steps of the length that suits the documents with a rate, and the short one that always descends."""
    own = max(float(np.linalg.eigvalsh(free)[-1]), 1e-12 * limit)
    scaled = [np.linalg.solve(free + damp * own * np.eye(len(gradient)), gradient) for damp in (1e-9, 1e-4, 1e-3, 1e-2, 1e-1)]
    return [*scaled, scaled[0] / 4, *(gradient * (far / own) for far in (1, 4, 16, 64)), gradient / limit]


@dataclass
class Fit:
    """Steps of the fit, expected tokens per domain at its end, and how it ended."""

    steps: list[np.ndarray]
    reached: np.ndarray
    gap: float  # largest distance from a target, as a share of that target
    rounds: int
    ended: str  # "targets met", "least squares" (they cannot be met), or "not converged"


def fit_rates(predicted: DataFrame, targets: np.ndarray, start: float, rounds: int = ROUNDS) -> Fit:
    """Projected gradient for the least squares of expected tokens against ``targets``; ``predicted`` is stored and read once per round.

    The gradient is scaled by the inverse of the domains' product matrix over the documents with a rate, so nearly parallel
    domains do not slow it down. Each round measures some steps at once (see ``_trials``) and keeps the one that comes closest. It
    ends when every target is met within TOLERANCE of itself, or when the projected gradient vanishes or no step helps any more.
    """
    size = len(targets)
    narrow = predicted.select("n_tokens", "posterior")
    scale = np.maximum(targets, 1e-3 * max(float(targets.sum()), 1.0))

    def evaluated(steps: list[np.ndarray], trials: list[np.ndarray], gradient: np.ndarray) -> tuple[float, np.ndarray, list]:
        found = narrow.mapInArrow(_sums(size, start, steps, trials, gradient), "sums array<double>")
        sums = np.zeros(1 + size * size + len(trials) * (size + size * size))
        for row in found.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect():
            sums[row["at"]] = row["x"]
        each = sums[1 + size * size :].reshape(len(trials), size + size * size)
        return float(sums[0]), sums[1 : 1 + size * size].reshape(size, size), [(e[:size], e[size:].reshape(size, size)) for e in each]

    steps: list[np.ndarray] = []
    _, square, [(reached, free)] = evaluated(steps, [np.zeros(size)], np.zeros(size))
    limit = max(float(np.linalg.eigvalsh(square)[-1]), 1e-300)
    first, ended = None, "not converged"
    for _ in range(rounds):
        gradient = reached - targets
        if (np.abs(gradient) <= TOLERANCE * scale).all():
            ended = "targets met"
            break
        trials = _trials(free, gradient, limit)
        norm, _, tried = evaluated(steps, trials, gradient)
        first = norm if first is None else first
        errors = [float(((t[0] - targets) ** 2).sum()) for t in tried]
        best = int(np.argmin(errors))
        if norm <= STATIONARY * first or errors[best] >= (1 - STALLED) * float((gradient**2).sum()):
            ended = "least squares"
            break
        steps.append(trials[best])
        reached, free = tried[best]
    gap = float((np.abs(reached - targets) / scale).max(initial=0.0))
    if ended == "not converged":
        warnings.warn(f"rates have not converged after {rounds} rounds, largest gap {gap:.4f} of a target", stacklevel=2)
    return Fit(steps, reached, gap, len(steps), ended)


def mix_to_targets(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], tokens: float = 1.0) -> DataFrame:
    """Per row of ``docs``: doc_id, source, version, n_tokens, posterior, rate, copies and gap. Jobs run while this is called.

    ``targets``: share of each domain. The mixture is to hold ``tokens`` times the corpus. ``copies`` is the rate rounded up or
    down by a hash of the document, so that it is the rate on average. ``gap``: the largest distance of expected tokens from a
    target, as a share of that target, the same in every row: beyond TOLERANCE the targets cannot be met (or the fit warned).
    """
    domains = tuple(targets)
    predicted = materialize(predict(docs, fit_classifier(docs, labels, domains)), "posteriors")
    total = predicted.agg(F.sum("n_tokens")).first()[0] or 0
    share = np.array([targets[d] for d in domains], np.float64)
    fit = fit_rates(predicted, share / share.sum() * total * tokens, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = _rates(_posterior_matrix(batch, len(domains)), tokens, fit.steps)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*batch.schema.names, "rate"])

    rated = predicted.mapInArrow(run, "doc_id long, source string, version long, n_tokens long, posterior array<double>, rate double")
    chance = F.pmod(F.xxhash64(F.coalesce("doc_id", "version"), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", copies.cast("long")).withColumn("gap", F.lit(fit.gap))
