"""Running totals and exact percentiles that hold when one group has most of the rows.

A plain window puts a whole group into one task. Here the rows are range-partitioned by group and
order, so a large group spans many slices. The running sum of a slice is taken in the task that holds
it, and the totals of the slices (one row per slice and group) give each its start: one shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Slice starts (one row per slice and group) up to this number are broadcast; beyond, the join is shuffled.
BROADCAST_STARTS = 500_000


def running_total(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    *,
    total: str | None = None,
    slices: int | None = None,
    slice_column: str | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the group (0 for the first).

    ``total`` names a further column with the sum over the whole group, ``slice_column`` one with the number of the slice
    (slices follow the order). NULL is a group too.
    Rows equal in ``order`` are told apart by their arrival, so even a group of identical rows is spread
    over slices; give rows with such copies as a scan, or a narrow function of one, so that a repeated
    task finds them in the same order. The sliced rows are written once while this is called, because both passes
    must see the same slices: give narrow rows.
    """
    keys = [*groups, *order, "_arrival"]
    arrived = df.withColumn("_arrival", F.monotonically_increasing_id())
    ranged = arrived.repartitionByRange(slices, *keys) if slices else arrived.repartitionByRange(*keys)
    sliced = ranged.sortWithinPartitions(*keys).drop("_arrival").withColumn("_slice", F.spark_partition_id())
    schema = T.StructType([*sliced.schema.fields, T.StructField("_within", T.LongType())])
    stored = materialize(sliced.mapInArrow(_sum_within(tuple(groups), value), schema), "running-total")

    slice_keys = [*groups, "_slice"]
    totals = stored.groupBy(*slice_keys).agg(F.sum(value).alias("_total"))
    earlier_slices = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *slice_keys,
        F.coalesce(F.sum("_total").over(earlier_slices), F.lit(0)).alias("_start"),
        F.sum("_total").over(Window.partitionBy(*groups)).alias("_group_total"),
    )
    starts = materialize(starts, "slice-starts")
    if starts.count() <= BROADCAST_STARTS:
        starts = F.broadcast(starts)

    added = [(F.col("_start") + F.col("_within")).alias(out)]
    if total:
        added.append(F.col("_group_total").alias(total))
    if slice_column:
        added.append(F.col("w._slice").alias(slice_column))
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"s.{k}")) for k in slice_keys]
    joined = stored.alias("w").join(starts.alias("s"), reduce(and_, same))
    return joined.select(*[F.col(f"w.{c}") for c in df.columns], *added)


def _sum_within(groups: tuple[str, ...], value: str):
    """Sum of ``value`` over the earlier rows of the same group in this partition, whose rows are in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            first = np.zeros(size, bool)
            for name in groups:
                code = batch[name].dictionary_encode("encode").indices.to_numpy()
                first[1:] |= code[1:] != code[:-1]
            key = tuple(batch[name][0].as_py() for name in groups)
            values = batch[value].cast(pa.int64()).fill_null(0).to_numpy()
            before = np.cumsum(values) - values
            start = np.concatenate([[0], np.flatnonzero(first)])
            run_of = np.cumsum(first)
            within = before - before[start][run_of]
            if key == last:
                within[run_of == 0] += carried
            last, carried = tuple(batch[name][size - 1].as_py() for name in groups), int(within[-1] + values[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(within)], names=[*batch.schema.names, "_within"])

    return run


def exact_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    fractions: dict[str, float],
    slices: int | None = None,
    *,
    mean: str | None = None,
    maximum: str | None = None,
) -> DataFrame:
    """Interpolated percentiles per group, one column per entry of ``fractions``, plus ``n``.

    Equal values are counted before the shuffle. No group is ever held in one buffer, unlike with the
    built-in ``percentile``. NULL is a group too; NULL values do not count, and a group of nothing else has ``n`` 0. ``mean`` and ``maximum`` name further columns, from the same counts.
    """
    counts = df.groupBy(*groups, value).agg(F.count(value).alias("_n"))
    placed = running_total(counts, groups, [value], "_n", "_before", total="n", slices=slices)

    def value_at(rank):
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col(value)))

    parts = []
    for name, fraction in fractions.items():
        position = (F.col("n") - 1) * F.lit(fraction)
        parts += [
            value_at(F.floor(position)).alias(f"_lo_{name}"),
            value_at(F.ceil(position)).alias(f"_hi_{name}"),
        ]
    ends = [(F.sum(F.col(value) * F.col("_n")) / F.nullif("n", F.lit(0))).alias(mean)] if mean else []
    ends += [F.max(value).alias(maximum)] if maximum else []
    found = placed.groupBy(*groups, "n").agg(*parts, *ends)
    results = [c for c in (mean, maximum) if c]
    for name, fraction in fractions.items():
        position = (F.col("n") - 1) * F.lit(fraction)
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*groups, "n", *results)
