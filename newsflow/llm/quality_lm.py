"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over bytes: words of open vocabularies are mostly new, their spelling is not. N-grams of all trusted text are
counted in every task first and merged in shards. A shard holds all n-grams with the same two bytes before the last,
and with them everything that their discounts and back-offs need: the context totals, the continuation counts of the
lower orders, down to three bytes. The two lowest orders have at most 65,536 entries and are shared by all shards.

For scoring, documents are dealt to groups; a group sends each distinct n-gram once to its shard, the shard joins them
with its counts and answers with log-probabilities, and the group adds them up. What is gathered thus grows with the
input, while no model has to fit into one place. The number of shards does not grow, so questions grow with the groups
alone; a copy of a shard answers at most ``ASKING_GROUPS`` of them.

Each document gets two perplexities: of the whole text, and of the least likely fiftieth of its words (one at least),
which a few foreign words in a long text raise. A document is rejected if either is beyond a quantile of its language. The
quantiles are taken over all trusted documents, on a grid of a thousandth of a nat. Trusted text is dealt to folds by a hash
of the text, so copies share one, and counted by fold: a trusted document is scored with all trusted text but its own
fold, every other document with all of it. An n-gram carries its fold, or the model it is asked of, above its five bytes.

Defined cases: a null or empty text has perplexity 1 and is kept. A language (also null) without trusted documents uses
the quantiles over all of them; without any, everything is kept. A row without doc_id is scored and never trusted. Repeated
labels must all be good for trust; repeated rows get the same decision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.tables import broadcast_up_to, materialize, text_bytes
from newsflow.llm.words import SPACED, U, chunks, mix

ORDER = 5
GROUP_BYTES = 8 << 20
LEAST_GROUPS = 24
SHARDS = 192
ASKING_GROUPS = 512  # groups that one task answers from its copy of a shard
HELD_NGRAMS = 1_000_000  # distinct n-grams that a counting task holds before it hands them on
FOLDS = 5
QUANTILE = 0.99
TAIL = 0.02
GRID = 1000
BROADCAST_ROWS = 500_000


def _mask(n: int) -> np.uint64:
    return U((1 << (8 * n)) - 1)


class _Bytes:
    """Texts of a chunk in one buffer, each after ORDER - 1 line feeds, with the n-gram that ends at every byte."""

    def __init__(self, texts: list[bytes | None]):
        pad = b"\n" * (ORDER - 1)
        data = np.frombuffer(b"".join(pad + (t or b"") for t in texts) + pad, np.uint8)
        size = np.array([len(t or b"") for t in texts])
        self.end = np.cumsum(size + ORDER - 1)
        self.start, self.size, self.data = self.end - size, size, data
        self.own = np.ones(len(data), bool)
        self.own[-(ORDER - 1) :] = False
        for k in range(1, ORDER):
            self.own[self.start - k] = False
        keys = np.zeros(len(data), U)
        for k in range(ORDER):
            keys[ORDER - 1 :] |= data[ORDER - 1 - k : len(data) - k].astype(U) << U(8 * k)
        self.keys = keys


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix((keys >> U(8)) & U(0xFFFF), 5) % U(shards)).astype(np.int32)


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of sorted ``keys`` by shard (sorted within), and (shard, from, to) of each."""
    shard = _shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    at = np.searchsorted(shard[order], np.arange(shards + 1))
    return order, [(s, int(at[s]), int(at[s + 1])) for s in range(shards) if at[s] < at[s + 1]]


def _fold_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> U(8 * ORDER)).astype(np.int64)


def _without_fold(keys: np.ndarray, counts: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and counts of all folds but one (-1: of all)."""
    on = _fold_of(keys) != fold
    return _merge([(keys[on] & _mask(ORDER), counts[on])])


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress well."""
    return np.diff(keys, prepend=U(0)).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, U), dtype=U)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with summed counts."""
    keys, counts = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, U), np.zeros(0, np.int64))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], (np.add.reduceat(counts, at) if len(at) else counts)


def _counter(shards: int):
    """Counts of a task's n-grams, handed on whenever they have grown, packed by shard."""

    def flush(parts: list) -> pa.RecordBatch:
        keys, counts = _merge(parts)
        order, slices = _by_shard(keys, shards)
        keys, counts = keys[order], counts[order]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([s for s, _, _ in slices], pa.int32()),
                pa.array([_pack(keys[a:b]) for _, a, b in slices], pa.binary()),
                pa.array([counts[a:b].tobytes() for _, a, b in slices], pa.binary()),
            ],
            names=["shard", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for part, texts in chunks(batch):
                found = _Bytes(texts)
                fold = batch["fold"].slice(part.start, len(texts)).to_numpy().astype(U)
                keys = found.keys | np.append(np.repeat(fold, found.size + ORDER - 1), np.zeros(ORDER - 1, U)) << U(8 * ORDER)
                parts.append(np.unique(keys[found.own], return_counts=True))
                if len(parts) >= 6:
                    parts = [_merge(parts)]
                    if len(parts[0][0]) > HELD_NGRAMS:
                        yield flush(parts)
                        parts = []
        yield flush(parts)

    return run


def _lower(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order ``n`` n-grams that end the (distinct) ones of order ``n + 1``, with the number of bytes before them."""
    return np.unique(keys & _mask(n), return_counts=True)


def _totals(folds: int):
    """Merged counts of a shard, and what each whole model needs of it: counts of counts, and numbers of bytes before pairs.

    The models are those without a fold, and at last that of all folds.
    """

    def run(table: pa.Table) -> pa.Table:
        keys, counts = _merge([(_unpack(k), np.frombuffer(c, np.int64)) for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)])
        stats, pairs, before = [], [], []
        for fold in [*range(folds), -1]:
            at, of = _without_fold(keys, counts, fold)
            for n in range(ORDER, 2, -1):
                if n < ORDER:
                    at, of = _lower(at, n)
                stats += [int((of == k).sum()) for k in (1, 2, 3, 4)]
            ends, left = _lower(at, 2)
            pairs.append(ends.astype(np.int64) | (fold % (folds + 1)) << 16)
            before.append(left)
        return pa.table(
            {
                "shard": table["shard"].slice(0, 1),
                "keys": [_pack(keys)],
                "counts": [counts.tobytes()],
                "stats": pa.array([stats], pa.list_(pa.int64())),
                "pairs": pa.array([np.concatenate(pairs).astype(np.int32)], pa.list_(pa.int32())),
                "before": pa.array([np.concatenate(before)], pa.list_(pa.int64())),
            }
        )

    return run


def _discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more.

    Where there are too few counts to estimate one, half the count is taken. No discount is nil: some probability must be
    left for what was never seen.
    """
    y = n1 / (n1 + 2 * n2) if n1 and n2 else None
    raw = [k - (k + 1) * y * after / of if y and of else k / 2 for k, of, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.1), k) for k, d in enumerate(raw, 1))])


def _low_orders(pairs: np.ndarray) -> np.ndarray:
    """Probability of the second byte of every pair, from the numbers of distinct bytes before each pair (256 x 256)."""
    single = (pairs > 0).sum(axis=0)

    def interpolated(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        d = _discounts(*((counts == k).sum() for k in (1, 2, 3, 4)))
        off = d[np.minimum(counts, 3)]
        total = counts.sum(axis=-1, keepdims=True)
        return np.where(total > 0, (counts - off + off.sum(axis=-1, keepdims=True) * below) / np.maximum(total, 1), below)

    return interpolated(pairs, interpolated(single[None, :], np.full((1, 256), 1 / 256)))


class Model:
    """What all shards share: discounts of orders 3 to ORDER, and probabilities by pairs of bytes.

    ``less``: the models that lack one fold each.
    """

    def __init__(self, discounts: dict[int, np.ndarray], pairs: np.ndarray, less: tuple[Model, ...] = ()):
        self.discounts, self.pairs, self.less = discounts, pairs, less

    def answers(self, asked: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log-probabilities of sorted n-grams that carry their model, with the counts by fold of their shard."""
        out, number = np.zeros(len(asked)), _fold_of(asked)
        for fold, model in enumerate((*self.less, self)):
            a, b = np.searchsorted(number, (fold, fold + 1))
            if a < b:
                known = _without_fold(keys, counts, fold if fold < len(self.less) else -1)
                out[a:b] = model.log_probabilities(asked[a:b] & _mask(ORDER), *known)
        return out

    def log_probabilities(self, asked: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of the last byte of each asked n-gram, with the counts of their shard."""
        tables = {ORDER: (keys, counts)}
        for n in range(ORDER - 1, 2, -1):
            tables[n] = _lower(tables[n + 1][0], n)
        below = self.pairs.ravel()
        known, chance = np.arange(1 << 16, dtype=U), below
        levels = []
        for n in range(3, ORDER + 1):
            grams, of = tables[n]
            if not len(grams):
                break
            off = self.discounts[n][np.minimum(of, 3)]
            context, at, which = np.unique(grams >> U(8), return_index=True, return_inverse=True)
            left = np.add.reduceat(off, at) / np.add.reduceat(of, at)
            total = np.add.reduceat(of, at)
            chance = (of - off) / total[which] + left[which] * chance[np.searchsorted(known, grams & _mask(n - 1))]
            known = grams
            levels.append((n, grams, np.log(chance), context, np.log(np.maximum(left, 1e-300))))
        out, todo = np.zeros(len(asked)), np.arange(len(asked))
        for n, grams, logs, context, left in reversed(levels):
            key = asked[todo] & _mask(n)
            at = np.minimum(np.searchsorted(grams, key), len(grams) - 1)
            hit = grams[at] == key
            out[todo[hit]] += logs[at[hit]]
            todo, key = todo[~hit], key[~hit] >> U(8)
            at = np.minimum(np.searchsorted(context, key), len(context) - 1)
            out[todo] += np.where(context[at] == key, left[at], 0.0)
        out[todo] += np.log(below[(asked[todo] & U(0xFFFF)).astype(np.int64)])
        return out


def train(texts: DataFrame, shards: int, folds: int = 0) -> tuple[Model, DataFrame]:
    """The shared part of the model, and its shards as (shard, keys, counts), one row each.

    ``texts`` has a ``fold`` below ``folds`` if there are any.
    """
    fold = F.col("fold").cast("int") if folds else F.lit(0).alias("fold")
    counted = texts.select(F.col("text").cast("string"), fold).mapInArrow(_counter(shards), "shard int, keys binary, counts binary")
    stored = materialize(
        counted.groupBy("shard").applyInArrow(_totals(folds), "shard int, keys binary, counts binary, stats array<long>, pairs array<int>, before array<long>"), "lm-shards"
    )
    each_model = 4 * (ORDER - 2)
    sums = stored.select(*[F.sum(F.col("stats")[k]) for k in range(each_model * (folds + 1))]).first()
    pairs = np.zeros((folds + 1, 256, 256), np.int64)
    # at most 65,536 rows per model: all pairs of bytes
    each = stored.select(F.explode(F.arrays_zip("pairs", "before")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.before").alias("n"))
    for row in each.collect():
        pairs[row.pair >> 16, row.pair >> 8 & 255, row.pair & 255] = row.n
    models: list[Model] = []
    for k in range(folds + 1):
        own = [x or 0 for x in sums[each_model * k : each_model * (k + 1)]]
        discounts = {n: _discounts(*own[4 * (ORDER - n) : 4 * (ORDER - n) + 4]) for n in range(3, ORDER + 1)}
        models.append(Model(discounts, _low_orders(pairs[k]), tuple(models) if k == folds else ()))
    return models[-1], stored.select("shard", "keys", "counts")


def _distinct(texts: pa.Table) -> np.ndarray:
    parts: list[np.ndarray] = []
    for _, part in chunks(texts):
        found = _Bytes(part)
        parts.append(np.unique(found.keys[found.own]))
        if len(parts) >= 16:
            parts = [np.unique(np.concatenate(parts))]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, U)


_ASK = "shard int, part int, grp int, keys binary"
_ANSWER = "grp int, shard int, logs binary"
_SCORES = "doc_id long, version long, lang string, trusted boolean, n_bytes long, nats double, tail_nats double"


def _asker(shards: int, asking: int):
    def run(texts: pa.Table) -> pa.Table:
        keys = _distinct(texts)
        order, slices = _by_shard(keys, shards)
        # a group's documents are all scored by one model
        keys, grp = keys[order] | U(texts["model"][0].as_py() << (8 * ORDER)), texts["grp"][0].as_py()
        return pa.table(
            {
                "shard": pa.array([s for s, _, _ in slices], pa.int32()),
                "part": pa.array([grp // asking] * len(slices), pa.int32()),
                "grp": pa.array([grp] * len(slices), pa.int32()),
                "keys": pa.array([_pack(keys[a:b]) for _, a, b in slices], pa.binary()),
            }
        )

    return run


def _answerer(model: Model):
    def run(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"grp": pa.array([], pa.int32()), "shard": pa.array([], pa.int32()), "logs": pa.array([], pa.binary())})
        known = (np.zeros(0, U), np.zeros(0, np.int64))
        if shard.num_rows:
            known = (_unpack(shard["keys"][0].as_py()), np.frombuffer(shard["counts"][0].as_py(), np.int64))
        keys = [_unpack(k) for k in asked["keys"].to_pylist()]
        every, which = np.unique(np.concatenate(keys), return_inverse=True)
        logs = model.answers(every, *known).astype(np.float32)[which]
        split = np.split(logs, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"grp": asked["grp"], "shard": asked["shard"], "logs": pa.array([x.tobytes() for x in split], pa.binary())})

    return run


class _Lookup:
    """Values of distinct keys in an open-addressing table: faster than a binary search for every byte of a text."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(U).max, U)
        self.values = np.zeros(1 << self.bits, np.float32)
        place, todo = self._place(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[place] == np.iinfo(U).max
            self.keys[place[free]] = keys[todo[free]]
            done = self.keys[place] == keys[todo]
            self.values[place[done]] = values[todo[done]]
            todo, place = todo[~done], (place[~done] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        out = self.values[place]
        todo = np.flatnonzero(self.keys[place] != keys)
        while len(todo):
            place[todo] = (place[todo] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[place[todo]] == keys[todo]
            out[todo[hit]] = self.values[place[todo[hit]]]
            todo = todo[~hit]
        return out


def _scorer(shards: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = _distinct(texts)
        order, slices = _by_shard(keys, shards)
        logs = np.zeros(len(keys), np.float32)
        found = dict(zip(answers["shard"].to_pylist(), answers["logs"].to_pylist(), strict=True))
        for s, a, b in slices:
            logs[a:b] = np.frombuffer(found[s], np.float32)
        lookup = _Lookup(keys[order], logs)
        nats, tails = [np.zeros(0)], [np.zeros(0)]
        for _, part in chunks(texts):
            whole, tail = _perplexities(_Bytes(part), lookup)
            nats.append(whole)
            tails.append(tail)
        size = pa.compute.binary_length(texts["text"].cast(pa.binary())).cast(pa.int64()).fill_null(0)
        return pa.table({**{c: texts[c] for c in ("doc_id", "version", "lang", "trusted")}, "n_bytes": size, "nats": np.concatenate(nats), "tail_nats": np.concatenate(tails)})

    return run


def _perplexities(found: _Bytes, lookup: _Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Nats per byte of each whole text, and of the least likely share of its words."""
    cost = np.zeros(len(found.data))
    cost[found.own] = -lookup.get(found.keys[found.own])
    sums = np.concatenate([[0.0], np.cumsum(cost)])
    whole = (sums[found.end] - sums[found.start]) / np.maximum(found.size, 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], SPACED[found.data] & found.own, [False]]).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    text = np.searchsorted(found.end, begin, side="right")
    end = np.minimum(end + 1, found.end[text])  # the space after a word tells if the word is whole
    each = (sums[end] - sums[begin]) / (end - begin)
    order = np.lexsort((-each, text))
    each, text = each[order], text[order]
    count = np.bincount(text, minlength=len(found.size))
    first = np.cumsum(count) - count
    take = np.maximum((count * TAIL).astype(np.int64), 1)
    chosen = np.arange(len(each)) - first[text] < take[text]
    tail = np.bincount(text[chosen], weights=each[chosen], minlength=len(found.size)) / np.maximum(np.minimum(take, count), 1)
    return whole, tail


def score(docs: DataFrame, trusted: DataFrame, shards: int | None = None, folds: int = 0, asking: int = ASKING_GROUPS) -> DataFrame:
    """Per row of ``docs``: doc_id, version (hash of the text), lang, trusted, n_bytes, nats, tail_nats.

    ``trusted``: doc_id of trusted documents, each once; all of them are counted. With ``folds`` they are scored without
    their own fold. A task answers at most ``asking`` groups. The model is trained while this is called.
    """
    groups = max(LEAST_GROUPS, -(-text_bytes(docs) // GROUP_BYTES))
    shards = shards or min(SHARDS, max(12, 2 * groups))
    known = broadcast_up_to(materialize(trusted.select("doc_id", F.lit(True).alias("known")), "trusted"), BROADCAST_ROWS)
    texts = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    is_trusted = F.coalesce("known", F.lit(False))
    fold = F.pmod(F.xxhash64("version"), F.lit(max(folds, 1))).cast("int")
    of_model = F.when(is_trusted & F.lit(folds > 0), fold).otherwise(F.lit(folds)).alias("model")
    marked = texts.join(known, "doc_id", "left").select("doc_id", "version", "lang", is_trusted.alias("trusted"), of_model, "text")
    model, stored = train(marked.filter("trusted").select("text", F.col("model").alias("fold")), shards, folds)
    # Groups of about the same size; each model has its own.
    size = {r.model: r.n or 0 for r in marked.groupBy("model").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    share = [max(1, round(groups * size.get(k, 0) / max(sum(size.values()), 1))) for k in range(folds + 1)]
    first, own = (F.element_at(F.array(*map(F.lit, x)), F.col("model") + 1) for x in ([sum(share[:k]) for k in range(folds + 1)], share))
    grp = (first + F.pmod(F.xxhash64("doc_id", "version"), own)).cast("int").alias("grp")
    dealt = marked.select(grp, "model", "doc_id", "version", "lang", "trusted", "text").repartition(2 * sum(share), "grp")
    by_group = dealt.groupBy("grp")
    asked = by_group.applyInArrow(_asker(shards, asking), _ASK)
    # Questions grow with the groups, so each shard is copied for every so many of them, and a task answers a bounded number.
    parts = F.explode(F.sequence(F.lit(0), F.lit((sum(share) - 1) // asking))).alias("part")
    copied = stored.select("shard", parts, "keys", "counts")
    answers = asked.groupBy("shard", "part").cogroup(copied.groupBy("shard", "part")).applyInArrow(_answerer(model), _ANSWER)
    return by_group.cogroup(answers.groupBy("grp")).applyInArrow(_scorer(shards), _SCORES)


def _limits(scored: DataFrame, quantile: float) -> DataFrame:
    """(everywhere, lang, nats, tail_nats) by language, and one row for all languages: exact quantiles on the grid.

    Counts per grid cell come first, so the running sums see a few thousand rows per language at most.
    """
    measures = ("nats", "tail_nats")
    each = F.explode(F.array(*[F.struct(F.lit(of).alias("of"), F.round(F.col(of) * GRID).cast("long").alias("cell")) for of in measures])).alias("x")
    held = scored.filter("trusted AND n_bytes > 0").select("lang", each).select("lang", "x.*")
    own = held.groupBy("lang", "of", "cell").agg(F.count("*").alias("n")).withColumn("everywhere", F.lit(False))
    cells = own.union(own.groupBy("of", "cell").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string"), "of", "cell", "n", F.lit(True)))
    part = Window.partitionBy("everywhere", "lang", "of")
    ranked = cells.withColumn("upto", F.sum("n").over(part.orderBy("cell"))).withColumn("total", F.sum("n").over(part))
    reached = ranked.filter(F.col("upto") >= quantile * F.col("total"))
    return reached.groupBy("everywhere", "lang").agg(*[F.min(F.when(F.col("of") == of, F.col("cell"))).alias(of) for of in measures])


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Per row of ``docs``: doc_id, version, lang, perplexity, tail_perplexity and kept. Jobs run while this is called.

    ``labels``: (doc_id, good) rows.
    """
    trusted = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("good", F.lit(False))).alias("good")).filter("good")
    scored = materialize(score(docs, trusted, folds=FOLDS), "scores")
    # Stored: a row per language, which is looked up by language and for all of them.
    limits = materialize(_limits(scored, quantile), "limits")
    mine = limits.filter("NOT everywhere").select(F.col("lang").alias("l"), F.col("nats").alias("nats_own"), F.col("tail_nats").alias("tail_nats_own"))
    judged = scored.join(F.broadcast(mine), F.col("lang").eqNullSafe(F.col("l")), "left")
    general = limits.filter("everywhere")
    limit = lambda of: F.coalesce(f"{of}_own", general.select(of).scalar())
    within = lambda of: F.coalesce(F.round(F.col(of) * GRID) <= limit(of), F.lit(True))
    return judged.select(
        "doc_id",
        "version",
        "lang",
        F.exp("nats").alias("perplexity"),
        F.exp("tail_nats").alias("tail_perplexity"),
        ((F.col("n_bytes") == 0) | within("nats") & within("tail_nats")).alias("kept"),
    )
