"""Languages of a document as a mixture, with the set of languages chosen by penalised likelihood.

A word is a run of letter bytes (a-z after lower-casing, and every byte beyond ASCII). Each language has a byte n-gram model that
gives a word's probability byte by byte from the three bytes before, learned from all labelled texts: tasks count
n-grams in hashed buckets per language, Spark sums them, and one table per language (``2 ** BITS`` floats, twice) is
what leaves the cluster. A document is a mixture of languages, each word coming from one of them: expectation-
maximisation estimates the proportions from the words' likelihoods, with the shares of the languages among the labelled
documents as a prior of one word. Then languages are taken out, least first, as long as the likelihood less
``PENALTY * languages * log(words)`` does not fall. All documents of a chunk step together as arrays.

Defined cases: a null text, and one without any letter, is ``und`` with score 0 and no languages; so is every
document if nothing was learned. A null label or text teaches nothing. A null doc_id counts as held out. Rows that
repeat a doc_id are judged by their own text. A tie goes to the language that comes first by name. Texts longer than a chunk
are read in pieces that end between words (a run of over 4,096 bytes without an end may be cut) and count equal words
once, so memory follows the distinct words. Empty tables give empty results; extra columns of the input are not read.
More than ``LANGUAGES`` distinct labels raise an error: then the column does not hold languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import materialize

BITS = 17
LANGUAGES = 512
UNKNOWN = "und"
CHUNK_BYTES = 1 << 20
LONGEST_RUN = 4096
PRIOR_WORDS = 1.0  # weight of the prior, in words
PENALTY = 0.5
STEPS = 15  # of expectation-maximisation
SMOOTHING, FLOOR = 1.0, 1 / 64  # weight and probability of an unseen byte
JUNK = -8.0  # log-probability that a word is of no language: bounds what one word can tell

LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[0x80:] = True
U = np.uint64


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the checksum of their number, is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


@dataclass
class Grams:
    """N-grams of a piece of text: buckets of each n-gram and of its context, and where each word begins among them."""

    gram: np.ndarray
    context: np.ndarray
    first: np.ndarray
    begin: np.ndarray  # byte range of each word in the piece
    end: np.ndarray
    data: np.ndarray


def _bucket(codes: np.ndarray, factor: int) -> np.ndarray:
    return ((codes * U(factor)) >> U(64 - BITS)).astype(np.int64)


def grams(texts: list[bytes]) -> Grams:
    """The n-grams of lower-cased texts: each byte of a word and its end, after up to three bytes of the word and its start."""
    data = np.frombuffer(b" " + b" ".join([*texts, b""]), np.uint8)
    letter = LETTER[data]
    codes = np.where(letter, data, 32).astype(U)
    edge = np.flatnonzero(np.diff(letter.view(np.int8)))
    begin, end = edge[0::2] + 1, edge[1::2] + 1
    at = np.flatnonzero(letter | np.concatenate([[False], letter[:-1]]))
    sizes = end - begin + 1
    first = np.cumsum(sizes) - sizes
    inner = np.arange(len(at)) - np.repeat(first, sizes)
    context = codes[at - 1] | (codes[at - 2] << U(8)) * (inner >= 1) | (codes[at - 3] << U(16)) * (inner >= 2)
    # Odd factors spread the codes over the upper bits.
    return Grams(_bucket(context << U(8) | codes[at], 0x9E3779B97F4A7C15), _bucket(context, 0xD6E8FEB86659FD93), first, begin, end, data)


def _pieces(text: str) -> Iterator[bytes]:
    """The lower-cased bytes of a text, cut between words where it is longer than a chunk."""
    data = text.lower().encode("utf-8", "surrogatepass")
    low = 0
    while len(data) - low > CHUNK_BYTES:
        high = low + CHUNK_BYTES
        breaks = np.flatnonzero(~LETTER[np.frombuffer(data, np.uint8, LONGEST_RUN, high - LONGEST_RUN)])
        high = high - LONGEST_RUN + int(breaks[-1]) + 1 if len(breaks) else high
        yield data[low:high]
        low = high
    yield data[low:]


def _chunks(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, one text at least."""
    low, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield low, k + 1
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of buckets per language, contexts after n-grams, given out at the end or when many languages are held."""
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, table in counts.items():
            used = np.flatnonzero(table)
            columns = [pa.array([lang] * (len(used) + 1)), pa.array(np.append(used, -1)), pa.array(np.append(table[used], documents[lang]))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])
        counts.clear()
        documents.clear()

    for batch in batches:
        for lang in batch["lang"].unique().to_pylist():
            if len(counts) >= 32:
                yield from out()
            texts = batch.filter(pa.compute.equal(batch["lang"], lang))["text"].to_pylist()
            table = counts.setdefault(lang, np.zeros(2 << BITS, np.int64))
            documents[lang] = documents.get(lang, 0) + len(texts)
            for low, high in _chunks(texts, CHUNK_BYTES):
                whole = [list(_pieces(t)) for t in texts[low:high]]
                for part in [[p[0] for p in whole], *([x] for p in whole for x in p[1:])]:
                    found = grams(part)
                    table[: 1 << BITS] += np.bincount(found.gram, minlength=1 << BITS)
                    table[1 << BITS :] += np.bincount(found.context, minlength=1 << BITS)
    yield from out()


@dataclass
class Model:
    """Languages by name, their shares among the labelled documents, and log tables of n-grams and contexts."""

    langs: list[str]
    share: np.ndarray
    gram: np.ndarray
    context: np.ndarray


def _packed(table: pa.Table) -> pa.Table:
    counts = np.zeros(2 << BITS, np.float32)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    documents = int(n[bucket < 0].sum())
    return pa.table({"lang": table["lang"][:1], "documents": pa.array([documents]), "counts": pa.array([counts.tobytes()], pa.binary())})


def fit(labelled: DataFrame) -> Model:
    """Learn from every row of (lang, text); the model has one table per language, whatever the number of rows."""
    rows = labelled.select(F.col("lang").cast("string"), F.col("text").cast("string")).dropna()
    summed = materialize(rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    langs = [r.lang for r in summed.filter("bucket < 0").select("lang").limit(LANGUAGES + 1).collect()]
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different labels")
    found = sorted(summed.groupBy("lang").applyInArrow(_packed, "lang string, documents long, counts binary").collect())
    counts = np.array([np.frombuffer(r.counts, np.float32) for r in found]).reshape(len(found), 2 << BITS)
    share = np.array([r.documents for r in found], float)
    gram, context = np.log(counts[:, : 1 << BITS] + SMOOTHING * FLOOR), np.log(counts[:, 1 << BITS :] + SMOOTHING)
    return Model([r.lang for r in found], share / max(share.sum(), 1), gram.astype(np.float32), context.astype(np.float32))


def _log_likelihoods(found: Grams, model: Model) -> np.ndarray:
    """Log-probability of each word under each language."""
    out = np.empty((len(found.first), len(model.langs)), np.float32)
    for k in range(len(model.langs)):
        if len(found.first):
            out[:, k] = np.add.reduceat(model.gram[k][found.gram] - model.context[k][found.context], found.first)
    return out


def _distinct(text: str, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Likelihoods and counts of the distinct words of a long text."""
    seen: dict[bytes, int] = {}
    rows, counts = [], []
    for piece in _pieces(text):
        found = grams([piece])
        words = [found.data[a:b].tobytes() for a, b in zip(found.begin.tolist(), found.end.tolist(), strict=True)]
        fresh = np.zeros(len(words), bool)
        for k, word in enumerate(words):
            at = seen.setdefault(word, len(counts))
            if at == len(counts):
                counts.append(0)
                fresh[k] = True
            counts[at] += 1
        rows.append(_log_likelihoods(found, model)[fresh])
    return np.concatenate(rows), np.array(counts, np.float64)


def _maximise(likely: np.ndarray, weight: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each document, and the log-likelihood, by expectation-maximisation."""
    base = np.where(allowed, prior, 0)
    base /= base.sum(1, keepdims=True)
    words = np.add.reduceat(weight, first)[:, None]
    share = base
    for _ in range(STEPS):
        joint = likely * share[doc]
        joint *= (weight / joint.sum(1))[:, None]
        share = (np.add.reduceat(joint, first, axis=0) + PRIOR_WORDS * base) / (words + PRIOR_WORDS)
    total = (likely * share[doc]).sum(1)
    return share, np.add.reduceat(weight * np.log(total), first)


def mixture(logs: np.ndarray, weight: np.ndarray, count: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: proportions with all languages, the chosen set of languages, and proportions within that set.

    ``logs``: words by languages; ``weight``: how often each word occurs; ``count``: words (rows) per document, 1 at least.
    """
    logs = logs.astype(np.float64)
    top = logs.max(1, keepdims=True)
    likely = np.exp(np.maximum(logs - top, -500)) * (1 - np.exp(JUNK)) + np.exp(JUNK)
    last = np.cumsum(count)
    first, doc = last - count, np.repeat(np.arange(len(count)), count)
    words = np.add.reduceat(weight, first)
    cost = PENALTY * np.log(words + 1)
    whole, value = _maximise(likely, weight, doc, first, np.ones((len(count), len(prior)), bool), prior)
    # Languages that explain less than half a word go at once, if the likelihood allows; then one by one, least first.
    chosen, share = np.ones(whole.shape, bool), whole
    value = value - cost * len(prior)
    open_ = np.arange(len(count))
    trial = whole * words[:, None] >= 0.5
    trial[np.arange(len(count)), whole.argmax(1)] = True
    while len(open_):
        rows = np.isin(doc, open_)
        place = np.searchsorted(open_, doc[rows])
        begin = np.searchsorted(place, np.arange(len(open_)))
        got, worth = _maximise(likely[rows], weight[rows], place, begin, trial, prior)
        worth = worth - cost[open_] * trial.sum(1)
        better = worth >= value[open_] - 1e-9
        taken = open_[better]
        chosen[taken], value[taken] = trial[better], worth[better]
        share = share.copy()
        share[taken] = got[better]
        # A first trial that took out too many is followed by single steps as well.
        left = chosen[open_]
        again = (better | (left.all(1) & (trial.sum(1) < left.sum(1) - 1))) & (left.sum(1) > 1)
        open_ = open_[again]
        trial = chosen[open_].copy()
        least = np.where(trial, share[open_], np.inf).argmin(1)
        trial[np.arange(len(open_)), least] = False
    return whole, chosen, share


_JUDGED = "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"


def _judge(model: Model, texts: list[str | None]) -> Iterator[tuple]:
    """(language, score, languages, shares) of each text."""
    plain = [t if t and any(map(str.isalpha, t)) else None for t in texts]
    usable = [k for k, t in enumerate(plain) if t] if model.langs else []
    judged: dict[int, tuple] = {}
    short = [k for k in usable if len(plain[k]) <= CHUNK_BYTES // 4]
    parts = []
    if short:
        found = grams([next(_pieces(plain[k])) for k in short])
        # Texts are joined by one blank after one blank in front: words are dealt out by where the texts end.
        ends = np.cumsum([len(plain[k].lower().encode("utf-8", "surrogatepass")) + 1 for k in short])
        count = np.diff(np.concatenate([[0], np.searchsorted(found.begin, ends, "right")]))
        parts.append((short, _log_likelihoods(found, model), np.ones(len(found.first)), count))
    for k in set(usable) - set(short):
        logs, weight = _distinct(plain[k], model)
        parts.append(([k], logs, weight, np.array([len(weight)])))
    for ids, logs, weight, count in parts:
        whole, chosen, share = mixture(logs, weight, count, model.share)
        for row, k in enumerate(ids):
            order = sorted(np.flatnonzero(chosen[row]).tolist(), key=lambda j: (-share[row, j], j))
            best = order[0]
            judged[k] = (model.langs[best], float(min(1.0, whole[row, best])), [model.langs[j] for j in order], [float(share[row, j]) for j in order])
    for k in range(len(texts)):
        yield judged.get(k, (UNKNOWN, 0.0, [], []))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages, shares) of every row by its text alone.

    ``languages`` is the chosen set, greatest share first; ``score`` is the share of the first one when all languages compete.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = CHUNK_BYTES * 16 // max(len(sent.value.langs), 16)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for low, high in _chunks(texts, limit):
                rows = list(zip(*_judge(sent.value, texts[low:high]), strict=True))
                types = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]
                columns = [batch["doc_id"].slice(low, high - low), *(pa.array(r, t) for r, t in zip(rows, types, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "languages", "shares"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _JUDGED)
