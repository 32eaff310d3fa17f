"""Operational rollups over service logs, output rows, enrichment results and migrations.

All groupings aggregate before they shuffle, so a frequent event or ticker is one partial row per
task. Percentiles are exact and never hold a group in one buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from .totals import exact_percentiles

# --- fixed values -----------------------------------------------------------------------------
# Event names are what stands before the first key=value pair, a colon or the end of the message.
EVENT = r"(?s)^(.*?)(?::|\s+\S+=|\z)"
SUMMARIZED = r"summarized$"
SUMMARY_FAILED = r"summarization-failed$"
# Written once per article that got no summary; other events that end like it are single attempts.
ARTICLE_FAILED = "summarization-failed"
THROTTLED = "bedrock-throttled"
RECONNECT = "ws-error"
MULTI_TICKER = "multi-ticker-article"
WRITTEN = "writing record"
MODEL_SWITCH = r"^Primary model \S+ not available"
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ssZ"
# US dollars per million tokens, input and output.
TOKEN_PRICES = (("large", "3.00", "15.00"), ("small", "0.25", "1.25"))
# A migrated row with at most this many words counts as fallback text.
FALLBACK_WORDS = 50
# ----------------------------------------------------------------------------------------------


def _value(key: str) -> Column:
    return F.nullif(F.regexp_extract("message", rf"(?:^|\s){key}=(\S+)", 1), F.lit(""))


def log_fields(logs: DataFrame) -> DataFrame:
    """Split ``message`` into ``event`` and its typed key=value pairs; absent keys are NULL."""
    event = F.when(F.col("message").rlike(MODEL_SWITCH), F.lit("model-switch")).otherwise(
        F.regexp_extract("message", EVENT, 1)
    )
    seconds = F.regexp_replace(F.coalesce(_value("retrying_in"), _value("reconnecting_in")), "s$", "")
    return logs.select(
        "level",
        "logger",
        F.try_to_timestamp("time", F.lit(LOG_TIME)).alias("time"),
        event.alias("event"),
        _value("ticker").alias("ticker"),
        _value("news_id").try_cast("bigint").alias("news_id"),
        _value("attempt").try_cast("bigint").alias("attempt"),
        _value("words").try_cast("bigint").alias("words"),
        _value("tickers").try_cast("bigint").alias("tickers"),
        _value("error_code").alias("error_code"),
        _value("reason").alias("reason"),
        seconds.try_cast("double").alias("wait_seconds"),
    )


def _is_summary_event(event: Column) -> Column:
    return event.rlike(SUMMARIZED) | event.rlike(SUMMARY_FAILED)


def outcomes(fields: DataFrame) -> DataFrame:
    """Summaries made and failed, by event."""
    return fields.where(_is_summary_event(F.col("event"))).groupBy("event").agg(F.count("*").alias("total"))


def success_rate(fields: DataFrame) -> DataFrame:
    """Summarized articles, articles tried, and their ratio, in one row. Failed attempts count in ``outcomes`` only."""
    event = F.col("event")
    made = F.count_if(event.rlike(SUMMARIZED))
    tried = F.count("*")
    return fields.where(event.rlike(SUMMARIZED) | (event == ARTICLE_FAILED)).agg(
        made.alias("successes"), tried.alias("attempts"), F.try_divide(made, tried).alias("success_rate")
    )


def retries(fields: DataFrame) -> DataFrame:
    """Throttled calls and their mean attempt number, by ticker."""
    return (
        fields.where(F.col("event") == THROTTLED)
        .groupBy("ticker")
        .agg(F.count("*").alias("retries"), F.avg("attempt").alias("avg_attempt"))
    )


def multi_ticker_log(fields: DataFrame) -> DataFrame:
    """Articles with several tickers according to the log: count, mean and maximum of tickers."""
    return fields.where(F.col("event") == MULTI_TICKER).agg(
        F.count("*").alias("articles"), F.avg("tickers").alias("avg_tickers"), F.max("tickers").alias("max_tickers")
    )


def multi_ticker_articles(articles: DataFrame) -> DataFrame:
    """The same from the articles themselves."""
    size = F.size("tickers").cast("bigint")
    return (
        articles.where(size > 1)
        .agg(F.count("*").alias("articles"), F.avg(size).alias("avg_tickers"), F.max(size).alias("max_tickers"))
    )


def per_minute(rows: DataFrame, time: str = "time") -> DataFrame:
    """Rows per minute of ``time``. On a stream give the input a watermark first."""
    counted = rows.groupBy(F.window(time, "1 minute").alias("_minute")).agg(F.count("*").alias("records"))
    return counted.select(F.col("_minute.start").alias("minute"), "records")


def errors(fields: DataFrame) -> DataFrame:
    """Warnings and errors by logger and event, with throttling and reconnects told apart."""
    return (
        fields.where(F.col("level").isin("WARNING", "ERROR"))
        .groupBy("logger", "event")
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("level") == "ERROR").alias("errors"),
            F.count_if(F.col("event") == THROTTLED).alias("throttled"),
            F.count_if(F.col("event") == RECONNECT).alias("reconnects"),
        )
    )


def latency(
    calls: DataFrame, groups: tuple[str, ...], elapsed: str = "elapsed_ms", slices: int | None = None
) -> DataFrame:
    """Exact median and 99th percentile of the call times, by ``groups``."""
    return exact_percentiles(calls, groups, elapsed, {"p50": 0.5, "p99": 0.99}, slices)


def lag(
    rows: DataFrame, event_ms: str, ingest_ms: str, groups: tuple[str, ...], slices: int | None = None
) -> DataFrame:
    """Delay between event and ingest time in ms, by ``groups``: count, mean, maximum, median, p99."""
    delayed = rows.withColumn("_lag", (F.col(ingest_ms) - F.col(event_ms)).cast("bigint"))
    ranks = {"p50_lag_ms": 0.5, "p99_lag_ms": 0.99}
    return exact_percentiles(delayed, groups, "_lag", ranks, slices, mean="avg_lag_ms", maximum="max_lag_ms")


def lag_windows_exact(
    rows: DataFrame, event_time: str, ingest_time: str, width: str = "1 minute", slices: int | None = None
) -> DataFrame:
    """Delay by window of the ingest time, for batch jobs: as ``lag``, with exact percentiles."""
    timed = rows.select(
        F.window(ingest_time, width)["start"].alias("window"),
        F.unix_millis(event_time).alias("_event_ms"),
        F.unix_millis(ingest_time).alias("_ingest_ms"),
    )
    return lag(timed, "_event_ms", "_ingest_ms", ("window",), slices)


def lag_windows(
    rows: DataFrame, event_time: str, ingest_time: str, width: str = "1 minute", accuracy: int = 10_000
) -> DataFrame:
    """Delay by window of the ingest time for streams (give the input a watermark first).

    The percentiles are approximate, with a rank error of ``1 / accuracy`` of a window's rows: a stream cannot rank
    its rows exactly, the sketch merges and has a fixed size. Batch jobs have ``lag_windows_exact``.
    """
    delay = F.unix_millis(ingest_time) - F.unix_millis(event_time)
    timed = rows.select(F.window(ingest_time, width).alias("_window"), delay.alias("_lag"))
    ranks = F.percentile_approx("_lag", [0.5, 0.99], accuracy)
    grouped = timed.groupBy("_window").agg(
        F.count("*").alias("n"),
        F.avg("_lag").alias("avg_lag_ms"),
        F.max("_lag").alias("max_lag_ms"),
        ranks.alias("_ranks"),
    )
    return grouped.select(
        F.col("_window.start").alias("window"),
        "n",
        "avg_lag_ms",
        "max_lag_ms",
        F.col("_ranks")[0].alias("p50_lag_ms"),
        F.col("_ranks")[1].alias("p99_lag_ms"),
    )


def rotation(rotated: DataFrame) -> DataFrame:
    """Files, rows and bytes of each ingest window."""
    return rotated.groupBy("ingest_dt", "hour", "part").agg(
        (F.max("file_seq") + 1).alias("files"), F.count("*").alias("records"), F.sum("bytes").alias("bytes")
    )


def token_prices(spark: SparkSession, prices=TOKEN_PRICES) -> DataFrame:
    rows = spark.createDataFrame(list(prices), "model STRING, price_in STRING, price_out STRING")
    return rows.select("model", *[F.col(c).cast("decimal(10,4)").alias(c) for c in ("price_in", "price_out")])


def cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost by model of ``usage`` (``model``, ``tokens_in``, ``tokens_out``); totals first, then prices.

    A model without a price stays, with its tokens and a NULL cost.
    """
    used = usage.groupBy("model").agg(
        F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out")
    )
    dollars = (F.col("tokens_in") * F.col("price_in") + F.col("tokens_out") * F.col("price_out")) / F.lit(1_000_000)
    return used.join(prices.withColumnRenamed("model", "_priced"), F.col("model") == F.col("_priced"), "left").select(
        "model", "calls", "tokens_in", "tokens_out", F.round(dollars.cast("double"), 6).alias("cost_usd")
    )


def migration_stats(done: DataFrame, failures: DataFrame) -> DataFrame:
    """Counters of a migration: articles that were migrated, and ``archive.migration_failures``, both with ``path``.

    With the columns of a service call, a summary is what a model answered. Stored rows have only ``content``, and a
    long one counts as a summary. Error texts are not gathered into this one row: failures are a table.
    """
    if "model_used" in done.columns:
        made = F.col("model_used").isNotNull() & F.col("summary").isNotNull()
    else:
        made = tx.word_count("content") > FALLBACK_WORDS
    rows = done.select("path", made.alias("_made")).union(failures.select("path", F.lit(None).cast("boolean")))
    return rows.agg(
        F.count_distinct("path").alias("files_processed"),
        F.count("*").alias("records_processed"),
        F.count("_made").alias("records_transformed"),
        F.count_if(F.col("_made").isNull()).alias("records_failed"),
        F.count_if("_made").alias("ai_summaries_generated"),
        F.count_if(~F.col("_made")).alias("html_fallbacks_used"),
    )


def size_reduction(cleaned: DataFrame, content: str = "content") -> DataFrame:
    """Bytes of the HTML bodies, of the cleaned texts and of the stored content, and what was saved."""
    raw = F.sum(F.octet_length(F.coalesce("body", F.lit(""))).cast("bigint"))
    clean = F.sum(F.octet_length("body_clean").cast("bigint"))
    kept = F.sum(F.octet_length(content).cast("bigint"))
    return cleaned.agg(
        F.count("*").alias("articles"),
        raw.alias("raw_bytes"),
        clean.alias("clean_bytes"),
        kept.alias("content_bytes"),
        (F.lit(1) - F.try_divide(kept, raw)).alias("saved"),
    )
