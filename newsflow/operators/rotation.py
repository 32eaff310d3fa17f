"""Size rotation exactly as a writer does it that closes a file once it has reached its limit.

A file that begins with a row goes on to the first row that finds the limit reached, so where files begin depends on
every earlier file of the window. Rows are in slices by their order, with the bytes before them. Within a slice the next
beginning of each row is one binary search, and following these jumps (by doubling) tells for each row that an earlier
file might end at: how many files begin from there on in the slice, and at which byte the last one does. Such a jump table covers only the
first ``limit`` bytes of a slice. Tables of ``FAN`` neighbouring slices are composed into one of the same size, level by
level, until one table is left per window; then the actual beginnings are handed down again. All levels stream sorted rows,
so no task holds a window, a third of all rows included, and there are log(slices) rounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .totals import running_total

FAN = 64
# Beginnings per slice and window (one row each) up to this number are broadcast; beyond, the join is shuffled.
BROADCAST_STATES = 500_000
BATCH_ROWS = 100_000

_JUMPS = "part string, unit long, low long, exit long, cuts long"
_STATES = "part string, unit long, start long, files long"


def greedy_files(
    df: DataFrame,
    window: str,
    order: Sequence[str],
    size: str,
    limit: int,
    *,
    slices: int | None = None,
    fan: int = FAN,
    opened: DataFrame | None = None,
) -> DataFrame:
    """Add ``bytes_before`` (of the window's earlier rows) and ``file_seq``, the number of the file a row goes to, from 0 on.

    ``opened`` (window, file_seq, bytes) names files that are open already and what they hold; windows that are not in it begin with
    an empty file 0. Rows are told apart by arrival where they are equal in ``order``. Narrow rows are stored while this is called.
    """
    if limit < 1:
        raise ValueError("a file holds at least one byte")
    # Stored by the running total already; the offsets are read from there as narrow columns.
    placed = running_total(df, [window], order, size, "bytes_before", slices=slices, slice_column="_slice")
    offsets = placed.select(_key(window).alias("part"), F.col("_slice").cast("long").alias("unit"), F.col("bytes_before").alias("low"))
    begin = _begin(offsets.select("part").distinct(), window, opened)

    levels = [materialize(offsets.groupBy("part", "unit").applyInArrow(_jumps(limit), _JUMPS), "jumps")]
    units = (placed.agg(F.max("_slice")).first()[0] or 0) + 1
    while units > fan:
        grouped = levels[-1].withColumn("group", F.expr(f"unit div {fan}"))
        levels.append(materialize(_in_order(grouped).mapInArrow(_compose(limit), _JUMPS), "jumps"))
        units = -(-units // fan)

    states = begin.withColumn("group", F.lit(0).cast("long"))
    for level in reversed(levels):
        own = level.withColumn("group", F.lit(0).cast("long")) if level is levels[-1] else level.withColumn("group", F.expr(f"unit div {fan}"))
        joined = own.join(_small(states), ["part", "group"])
        found = materialize(_in_order(joined).mapInArrow(_follow(limit), _STATES), "file-starts")
        states = found.withColumnRenamed("unit", "group")

    cuts = offsets.groupBy("part", "unit").cogroup(found.groupBy("part", "unit")).applyInArrow(_cut(limit), "part string, unit long, files long, cuts array<long>")
    told = _small(materialize(cuts, "cuts"))
    same = (_key(f"w.{window}") == F.col("s.part")) & (F.col("w._slice") == F.col("s.unit"))
    joined = placed.alias("w").join(told.alias("s"), same)
    earlier = F.size(F.filter("s.cuts", lambda c: c <= F.col("w.bytes_before")))
    return joined.select(*[F.col(f"w.{c}") for c in df.columns], "w.bytes_before", (F.col("s.files") + earlier).alias("file_seq"))


def _key(window: str) -> Column:
    """The window as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(window).cast("string")), F.lit(""))


def _begin(parts: DataFrame, window: str, opened: DataFrame | None) -> DataFrame:
    """(part, start, files): the byte, counted from the first row on, at which the open file of a window began, and its number."""
    if opened is None:
        return parts.select("part", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("files"))
    held = opened.select(_key(window).alias("part"), (-F.col("bytes")).cast("long").alias("start"), F.col("file_seq").cast("long").alias("files"))
    return parts.join(held, "part", "left").select("part", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("start", "files")))


def _small(states: DataFrame) -> DataFrame:
    return F.broadcast(states) if states.count() <= BROADCAST_STATES else states


def _in_order(jumps: DataFrame) -> DataFrame:
    return jumps.repartition("part", "group").sortWithinPartitions("part", "group", "unit", "low")


def _chains(low: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the sorted offsets as the beginning of a file: the last beginning that follows from it, and how many there are."""
    n = len(low)
    after = np.searchsorted(low, low + limit, "left")  # n: none
    last, count = np.arange(n + 1), np.concatenate([np.ones(n, np.int64), [0]])
    jump = np.append(after, n)
    while (jump[:n] < n).any():
        ahead = jump < n
        count = np.where(ahead, count + count[jump], count)
        last = np.where(ahead, last[jump], last)
        jump = jump[jump]
    return low[last[:n]], count[:n]


def _entries(low: np.ndarray, begin: int, limit: int) -> int:
    """How many of the sorted offsets the file that is open at ``begin`` may end at: those before ``begin + limit``, and one more."""
    return min(int(np.searchsorted(low, begin + limit, "left")) + 1, len(low))


def _table(part, unit, low, last, cuts) -> pa.Table:
    n = len(low)
    columns = [pa.array([part] * n, pa.string()), pa.array(np.full(n, unit, np.int64)), pa.array(low), pa.array(last), pa.array(cuts)]
    return pa.table(columns, names=["part", "unit", "low", "exit", "cuts"])


def _offsets(table: pa.Table) -> np.ndarray:
    """Distinct: of rows at the same byte (after empty ones) the first begins the file."""
    return np.unique(table["low"].to_numpy())


def _jumps(limit: int):
    def run(table: pa.Table) -> pa.Table:
        low = _offsets(table)
        last, cuts = _chains(low, limit)
        n = _entries(low, int(low[0]), limit)
        return _table(table["part"][0].as_py(), table["unit"][0].as_py(), low[:n], last[:n], cuts[:n])

    return run


class _Runs:
    """Reads sorted rows and gives each table (part, group, unit) in turn, whatever batches it comes in."""

    def __init__(self, columns: Sequence[str]):
        self.columns = columns

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
        key, held = None, []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = [batch[c] for c in ("part", "group", "unit")]
            codes = [c.dictionary_encode("encode").indices.to_numpy() for c in names]
            edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
            for a, b in zip([0, *edge], [*edge, n], strict=True):
                mine = tuple(c[int(a)].as_py() for c in names)
                if held and mine != key:
                    yield key, self._joined(held)
                    held = []
                key = mine
                held.append({c: batch[c].slice(int(a), int(b - a)).to_numpy() for c in self.columns})
        if held:
            yield key, self._joined(held)

    @staticmethod
    def _joined(held: list[dict]) -> dict[str, np.ndarray]:
        return {c: np.concatenate([h[c] for h in held]) for c in held[0]}


def _compose(limit: int):
    """One jump table per group of units, from those of its units in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, low, last, cuts, begin = None, None, None, None, 0

        def done() -> Iterator[pa.RecordBatch]:
            if group is not None:
                yield from _table(group[0], group[1], low, last, cuts).to_batches(BATCH_ROWS)

        for key, table in _Runs(("low", "exit", "cuts"))(batches):
            if key[:2] != group:
                yield from done()
                group, begin = key[:2], int(table["low"][0])
                low, last, cuts = (np.zeros(0, np.int64) for _ in range(3))
            # Files that are open where this unit begins end at its first row beyond their limit, if it has one.
            at = np.searchsorted(table["low"], last + limit, "left")
            on = at < len(table["low"])
            last[on], cuts[on] = table["exit"][at[on]], cuts[on] + table["cuts"][at[on]]
            if not len(low) or low[-1] < begin + limit:
                n = _entries(table["low"], begin, limit)
                low, last, cuts = (np.concatenate([old, table[c][:n]]) for old, c in ((low, "low"), (last, "exit"), (cuts, "cuts")))
        yield from done()

    return run


def _follow(limit: int):
    """The file that is open where each unit begins: the byte at which it began, and its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, start, files, rows = None, 0, 0, []
        for key, table in _Runs(("low", "exit", "cuts", "start", "files"))(batches):
            if key[:2] != group:
                group, start, files = key[:2], int(table["start"][0]), int(table["files"][0])
            rows.append((key[0], key[2], start, files))
            at = int(np.searchsorted(table["low"], start + limit, "left"))
            if at < len(table["low"]):
                start, files = int(table["exit"][at]), files + int(table["cuts"][at])
            if len(rows) >= BATCH_ROWS:
                yield _states(rows)
                rows = []
        yield _states(rows)

    return run


def _states(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["part", "unit", "start", "files"])


def _cut(limit: int):
    """The bytes at which files begin in a slice, given the one that is open at its start."""

    def run(table: pa.Table, state: pa.Table) -> pa.Table:
        low, at = _offsets(table), state["start"][0].as_py()
        cuts = []
        while (k := int(np.searchsorted(low, at + limit, "left"))) < len(low):
            at = int(low[k])
            cuts.append(at)
        return pa.table({"part": state["part"], "unit": state["unit"], "files": state["files"], "cuts": pa.array([cuts], pa.list_(pa.int64()))})

    return run
