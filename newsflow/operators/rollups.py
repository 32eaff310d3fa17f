"""Rollups that can be rolled up again: distributions per minute that merge to hours and days, and log counts as deltas.

A distribution is kept as count, sum, maximum and a KLL sketch, whose size depends on ``k`` and not on the rows. Merging sketches
keeps their rank error (about 1.3 % at k = 200, 0.1 % at 4,096); a sketch of at most k values is exact. All aggregates are merged in the
tasks before they are shuffled, so one dominant group is a row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .monitor import MULTI_TICKER, RECONNECT, SUMMARIZED, SUMMARY_FAILED, THROTTLED

SKETCH_K = 4096
LOG_KEYS = ("minute", "logger", "level", "event", "ticker")


def distributions(rows: DataFrame, time: str, value: str, groups: Sequence[str] = (), width: str = "1 minute", k: int = SKETCH_K) -> DataFrame:
    """(start, groups, n, total, highest, sketch) of ``value`` by window of ``time``; rows without time or value are left out.

    Also on a stream: give it a watermark first, and write in append mode.
    """
    known = rows.where(F.col(time).isNotNull() & F.col(value).isNotNull()).withColumn("_value", F.col(value).cast("double"))
    found = known.groupBy(F.window(time, width).alias("_window"), *groups).agg(
        F.count("*").alias("n"), F.sum("_value").alias("total"), F.max("_value").alias("highest"), F.kll_sketch_agg_double("_value", k).alias("sketch")
    )
    return found.select(F.col("_window.start").alias("start"), *groups, "n", "total", "highest", "sketch")


def rolled_up(rollup: DataFrame, groups: Sequence[str] = (), width: str = "1 hour", k: int = SKETCH_K) -> DataFrame:
    """The same by wider windows (and fewer groups), from ``distributions`` or from itself."""
    found = rollup.groupBy(F.window("start", width).alias("_window"), *groups).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("highest").alias("highest"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    return found.select(F.col("_window.start").alias("start"), *groups, "n", "total", "highest", "sketch")


def quantiles(rollup: DataFrame, ranks: Mapping[str, float]) -> DataFrame:
    """One column per entry of ``ranks``: the smallest value that so large a share of the values does not exceed; and the mean."""
    columns = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias(name) for name, r in ranks.items()]
    return rollup.select(*[c for c in rollup.columns if c not in ("total", "sketch")], (F.col("total") / F.col("n")).alias("mean"), *columns)


def log_counts(fields: DataFrame) -> DataFrame:
    """Counts of parsed log lines by minute, logger, level, event and ticker, with the sums that the rollups below need.

    Only throttled calls keep their ticker. Lines without a readable time are under a NULL minute.
    """
    ticker = F.when(F.col("event") == THROTTLED, F.col("ticker")).alias("ticker")
    keyed = fields.select(F.date_trunc("minute", "time").alias("minute"), "logger", "level", "event", ticker, "attempt", "tickers")
    return keyed.groupBy(*LOG_KEYS).agg(
        F.count("*").alias("lines"),
        F.sum("attempt").alias("attempts"),
        F.count("attempt").alias("with_attempt"),
        F.sum("tickers").alias("tickers"),
        F.count("tickers").alias("with_tickers"),
        F.max("tickers").alias("most_tickers"),
    )


def outcomes(counts: DataFrame) -> DataFrame:
    """As ``monitor.outcomes``, from counts."""
    made = F.col("event").rlike(SUMMARIZED) | F.col("event").rlike(SUMMARY_FAILED)
    return counts.where(made).groupBy("event").agg(F.sum("lines").alias("total"))


def retries(counts: DataFrame) -> DataFrame:
    """As ``monitor.retries``, from counts."""
    mean = _mean("attempts", "with_attempt").alias("avg_attempt")
    return counts.where(F.col("event") == THROTTLED).groupBy("ticker").agg(F.sum("lines").alias("retries"), mean)


def multi_ticker(counts: DataFrame) -> DataFrame:
    """As ``monitor.multi_ticker_log``, from counts."""
    mean = _mean("tickers", "with_tickers").alias("avg_tickers")
    some = counts.where(F.col("event") == MULTI_TICKER)
    return some.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("articles"), mean, F.max("most_tickers").alias("max_tickers"))


def per_minute(counts: DataFrame) -> DataFrame:
    """As ``monitor.per_minute``, from counts."""
    return counts.where(F.col("minute").isNotNull()).groupBy("minute").agg(F.sum("lines").alias("records"))


def errors(counts: DataFrame) -> DataFrame:
    """As ``monitor.errors``, from counts."""
    lines = lambda on: F.sum(F.when(on, F.col("lines")).otherwise(0))
    found = counts.where(F.col("level").isin("WARNING", "ERROR")).groupBy("logger", "event")
    return found.agg(
        F.sum("lines").alias("total"),
        lines(F.col("level") == "ERROR").alias("errors"),
        lines(F.col("event") == THROTTLED).alias("throttled"),
        lines(F.col("event") == RECONNECT).alias("reconnects"),
    )


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(n))
