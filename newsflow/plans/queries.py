"""The registered queries: each runs one operator over a whole driver table.

Every callable takes ``(spark, sf_dir)``. ``oracle.py`` has the SQL of the same names. Lists are joined
with ``|`` and timestamps shown as epoch milliseconds, so that both engines give plain values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts, times
from ..functions import text as tx
from ..functions.tickers import primary_ticker
from ..operators import archive, enrich, ingest, monitor, records, rollups, summary_store, windows
from ..session import materialize, shared_dir
from ..sources import bad_lines, number_lines, parse_lines, read_archive
from . import pipeline
from . import sample_messages as sample


def _joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def _size(name: str) -> Column:
    return F.size(name).cast("bigint")


def _flat_records(rows: DataFrame, *keep: str) -> DataFrame:
    shown = {
        "authors": F.array_join("authors", "|"),
        "channels": F.array_join("channels", "|"),
        "created_at": F.unix_millis("created_at"),
        "updated_at": F.unix_millis("updated_at"),
        "pos": F.col("pos").cast("bigint"),
    }
    return rows.select(*[shown.get(c, F.col(c)).alias(c) for c in rows.columns if c != "ingest_ts" or c in keep])


def _articles(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    parsed = ingest.parse_messages(sample.messages(spark, sf_dir, source))
    return ingest.accepted(parsed)


def _cleaned(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    return records.clean_articles(_articles(spark, sf_dir, source))


def _records(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    """Without a service: every article with its whole text."""
    return pipeline.articles_to_records(_articles(spark, sf_dir, source), None, keep=("ingest_ts",), fallback_chars=None)


# The service of the registered queries: the lead of the cleaned text, in whole sentences.
_SERVICE, _POLICY = enrich.LeadingSentences(), enrich.CallPolicy(max_words=200)


def _cleaned_text() -> Column:
    return F.when(~tx.is_blank("body_clean"), F.col("body_clean"))


def _summarized(spark: SparkSession, sf_dir: str, source: str = "documents", store_content: bool = False) -> DataFrame:
    articles = _articles(spark, sf_dir, source)
    return pipeline.articles_to_records(
        articles, _SERVICE, _POLICY, ("ingest_ts",), store_content=store_content, text=_cleaned_text()
    )


def validate_split(spark, sf_dir):
    parsed = ingest.parse_messages(sample.faulty_messages(spark, sf_dir, "documents"))
    return parsed.select("key", F.coalesce("reason", F.lit("accepted")).alias("outcome"))


def quarantine_counts(spark, sf_dir):
    rejects = ingest.quarantine(ingest.parse_messages(sample.faulty_messages(spark, sf_dir, "documents")))
    return rejects.groupBy("reason").agg(F.count("*").alias("messages"))


def quarantine_errors(spark, sf_dir):
    rejects = ingest.quarantine(ingest.parse_messages(sample.faulty_messages(spark, sf_dir, "documents")))
    errors = rejects.select("reason", F.explode("errors").alias("e")).select("reason", "e.*")
    return errors.groupBy("reason", "field", "sent", "wanted").agg(F.count("*").alias("messages"))


def typed_messages(spark, sf_dir):
    parsed = ingest.accepted(ingest.parse_messages(sample.faulty_messages(spark, sf_dir, "documents")))
    return parsed.select(
        "key",
        "api_version",
        "kind",
        "id",
        F.unix_micros("timestamp").alias("timestamp_us"),
        "action",
        "content_id",
        "revision_id",
        "type",
        "title",
        "body",
        "teaser",
        "url",
        _joined("authors"),
        _joined("channels"),
        _size("securities").alias("n_securities"),
        F.unix_millis("created_at").alias("created_ms"),
        F.unix_millis("updated_at").alias("updated_ms"),
    )


def coerce_lists(spark, sf_dir):
    parsed = ingest.parse_messages(sample.messages(spark, sf_dir, "documents"))
    return parsed.select("key", _joined("authors"), _joined("channels"), _size("securities").alias("n_securities"))


def extract_symbols(spark, sf_dir):
    parsed = ingest.parse_messages(sample.messages(spark, sf_dir, "documents"))
    first = primary_ticker(F.col("tickers")).alias("primary_ticker")
    return parsed.select("key", _joined("tickers"), _size("tickers").alias("n_tickers"), first)


def clean_steps(spark, sf_dir):
    bodies = sample.table(spark, sf_dir, "pages").select("page_id", tx.drop_markup("html").alias("stripped"))
    unescaped = bodies.withColumn("unescaped", tx.unescape("stripped"))
    return unescaped.withColumn("cleaned", tx.tidy_space("unescaped"))


def clean_articles(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("key", "body_clean", "teaser_clean", "primary_ticker")


def clean_size(spark, sf_dir):
    ready = records.choose_content(_cleaned(spark, sf_dir))
    done = enrich.summarize_articles(ready, _SERVICE, _POLICY, text=_cleaned_text())
    sizes = monitor.size_reduction(done.withColumn("content", F.coalesce(F.nullif("summary", F.lit("")), "content")))
    return sizes.withColumn("saved", F.round("saved", 6))


def fallback_content(spark, sf_dir):
    rows = sample.articles(spark, sf_dir, "documents")
    body = F.when(F.col("key") % 5 != 0, F.col("body")).otherwise(F.lit(""))
    title = F.when(F.col("key") % 2 != 0, F.col("title"))
    return rows.select("key", tx.fallback_content(body, F.col("teaser"), title).alias("content"))


def _with_blank_bodies(spark, sf_dir):
    rows = _cleaned(spark, sf_dir, "documents")
    return rows.withColumn("body_clean", F.when(F.col("key") % 5 != 0, F.col("body_clean")).otherwise(F.lit(" ")))


def summary_routing(spark, sf_dir):
    done = enrich.summarize_articles(_with_blank_bodies(spark, sf_dir), _SERVICE, _POLICY, text=_cleaned_text())
    return done.select("key", F.col("summary").isNotNull().alias("has_summary"), "attempts")


def summarize_extractive(spark, sf_dir):
    policy = enrich.CallPolicy(max_words=60)
    done = enrich.summarize_articles(_with_blank_bodies(spark, sf_dir), _SERVICE, policy, text=_cleaned_text())
    return done.select("key", "summary", "attempts", "model_used")


def reused_summaries(spark, sf_dir):
    """Every second article was summarized before: its summary is found again and not asked for."""
    columns, text = ("key", "id"), _cleaned_text()
    articles = materialize(_cleaned(spark, sf_dir, "documents").select(*columns, "body_clean", "teaser_clean"), "cleaned")
    first = enrich.summarize_articles(articles.where(F.col("key") % 2 == 0), _SERVICE, _POLICY, text=text, columns=columns)
    stored = enrich.summary_store(materialize(first, "summaries"))
    done = enrich.summarize_articles(articles, _SERVICE, _POLICY, text=text, stored=stored, columns=columns, read_again=True)
    return done.select("key", "summary", "attempts")


def store_summaries(spark, sf_dir):
    """As ``reused_summaries``, from a bucketed store that was filled in two changes and compacted."""
    columns, text = ("key", "id"), _cleaned_text()
    articles = materialize(_cleaned(spark, sf_dir, "documents").select(*columns, "body_clean", "teaser_clean"), "cleaned")
    first = enrich.summarize_articles(articles.where(F.col("key") % 2 == 0), _SERVICE, _POLICY, text=text, columns=columns)
    made = enrich.summary_store(materialize(first, "summaries"))
    store = summary_store.create_store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", buckets=8)
    for half in (0, 2):
        store.add(made.where(F.col("news_id") % 4 == half))
    done = enrich.summarize_articles(articles, _SERVICE, _POLICY, text=text, stored=store.compact(), columns=columns)
    return done.select("key", "summary", "attempts")


def article_prompts(spark, sf_dir):
    rows = _with_blank_bodies(spark, sf_dir)
    prompt = prompts.article_prompt(F.col("primary_ticker"), F.col("title"), F.col("body_clean"), F.col("teaser_clean"))
    limit = F.lit(prompts.max_tokens(prompts.DEFAULT_MAX_WORDS)).cast("bigint")
    return rows.select("key", prompt.alias("prompt"), limit.alias("max_tokens"))


def html_prompts(spark, sf_dir):
    rows = _articles(spark, sf_dir)
    prompt = prompts.html_prompt(primary_ticker(F.col("tickers")), F.col("title"), F.col("body"), 150)
    return rows.select("key", prompt.alias("prompt"), F.lit(prompts.max_tokens(150)).cast("bigint").alias("max_tokens"))


def word_count(spark, sf_dir):
    return sample.table(spark, sf_dir, "documents").select("doc_id", tx.word_count("text").alias("words"))


def preview(spark, sf_dir):
    docs = sample.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", tx.preview("text").alias("preview"), F.char_length("text").cast("bigint").alias("n_characters")
    )


def ticker_records(spark, sf_dir):
    return _flat_records(_records(spark, sf_dir))


def document_records(spark, sf_dir):
    return _flat_records(_records(spark, sf_dir, "documents"))


def summarized_records(spark, sf_dir):
    return _flat_records(_summarized(spark, sf_dir))


def summarized_lines(spark, sf_dir):
    lines = records.to_ndjson(_summarized(spark, sf_dir))
    return lines.select("news_id", F.col("pos").cast("bigint").alias("pos"), "line", "bytes")


def by_ticker(spark, sf_dir):
    return _flat_records(records.by_ticker(_records(spark, sf_dir), "T4"))


def ndjson_lines(spark, sf_dir):
    lines = records.to_ndjson(_records(spark, sf_dir))
    return lines.select("news_id", F.col("pos").cast("bigint").alias("pos"), "line", "bytes")


def assign_windows(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ingest_ts"))
    default = windows.assign_windows(events)
    wide = times.window_start(F.col("ingest_ts"), 120)
    odd = times.window_start(F.col("ingest_ts"), 45)
    return default.select(
        "event_id",
        "ingest_dt",
        "hour",
        "part",
        F.unix_millis(odd).alias("start_45"),
        times.window_label(odd, 45).alias("part_45"),
        times.window_label(wide, 120).alias("part_120"),
    )


def _rotated(spark, sf_dir):
    lines = windows.assign_windows(records.to_ndjson(_summarized(spark, sf_dir, store_content=True)))
    narrow = lines.select(*windows.PARTITION_COLUMNS, "ingest_ts", "news_id", "pos", "bytes")
    return windows.rotate_files(narrow, 20_000)


def rotate_files(spark, sf_dir):
    return _rotated(spark, sf_dir).select(
        "news_id", F.col("pos").cast("bigint").alias("pos"), "part", "bytes", "bytes_before", "file_seq"
    )


def mon_rotation(spark, sf_dir):
    return monitor.rotation(_rotated(spark, sf_dir))


def rewrite_archive(spark, sf_dir):
    return archive.rewrite_lines(sample.archive_lines(spark, sf_dir))


def lenient_lines(spark, sf_dir):
    parsed = parse_lines(sample.archive_lines(spark, sf_dir))
    return parsed.select("key", F.col("value").isNotNull().cast("bigint").alias("is_json"))


def bad_line_numbers(spark, sf_dir):
    """Archive files of the events, three of them; every line that is not JSON with its file and number."""
    lines = sample.archive_lines(spark, sf_dir).select("line", "key", (F.col("key") % 3).alias("file"))
    folder = f"{shared_dir(spark)}/archive-{uuid.uuid4().hex}"
    lines.repartition("file").sortWithinPartitions("file", "key").select("file", "line").write.partitionBy("file").option("lineSep", "\n").text(folder)
    bad = bad_lines(parse_lines(number_lines(read_archive(spark, folder))))
    return bad.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("bigint").alias("file"), "line_number")


def _backfilled(spark, sf_dir, text: Column, **options) -> DataFrame:
    rows = archive.backfill(sample.legacy_lines(spark, sf_dir), _SERVICE, _POLICY, text=text, **options)
    return rows.select("path", "news_id", "ticker", "timestamp", "action", "title", "content", _joined("authors"))


def legacy_backfill(spark, sf_dir):
    return _backfilled(spark, sf_dir, _cleaned_text())


def legacy_backfill_html(spark, sf_dir):
    return _backfilled(spark, sf_dir, F.when(~tx.is_blank("body"), F.col("body")), html=True)


def migration_failures(spark, sf_dir):
    failures = archive.migration_failures(archive.read_legacy(sample.legacy_lines(spark, sf_dir)))
    return failures.select("path", "key", "reason")


def migration_stats(spark, sf_dir):
    lines = sample.legacy_lines(spark, sf_dir)
    done = archive.migrate(lines, _SERVICE, _POLICY, text=_cleaned_text())
    return monitor.migration_stats(done, archive.migration_failures(archive.read_legacy(lines)))


def log_fields(spark, sf_dir):
    fields = monitor.log_fields(sample.service_logs(spark, sf_dir))
    return fields.select(
        "level",
        "logger",
        F.unix_millis("time").alias("time_ms"),
        "event",
        "ticker",
        "news_id",
        "attempt",
        "words",
        "tickers",
        "error_code",
        "reason",
        "wait_seconds",
    )


def _fields(spark, sf_dir):
    return monitor.log_fields(sample.service_logs(spark, sf_dir))


def mon_outcomes(spark, sf_dir):
    return monitor.outcomes(_fields(spark, sf_dir))


def mon_success_rate(spark, sf_dir):
    return monitor.success_rate(_fields(spark, sf_dir)).withColumn("success_rate", F.round("success_rate", 6))


def mon_retries(spark, sf_dir):
    return monitor.retries(_fields(spark, sf_dir)).withColumn("avg_attempt", F.round("avg_attempt", 6))


def mon_multi_ticker(spark, sf_dir):
    return monitor.multi_ticker_log(_fields(spark, sf_dir)).withColumn("avg_tickers", F.round("avg_tickers", 6))


def mon_multi_ticker_articles(spark, sf_dir):
    found = monitor.multi_ticker_articles(_articles(spark, sf_dir, "documents"))
    return found.withColumn("avg_tickers", F.round("avg_tickers", 6))


def mon_per_minute(spark, sf_dir):
    written = _fields(spark, sf_dir).where(F.col("event") == monitor.WRITTEN)
    return monitor.per_minute(written).select(F.unix_millis("minute").alias("minute_ms"), "records")


def mon_errors(spark, sf_dir):
    return monitor.errors(_fields(spark, sf_dir))


def _elapsed(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events")
    # Signups have no group, as failed calls have no model.
    return events.select(F.nullif("event_type", F.lit("signup")).alias("event_type"), F.col("value").alias("elapsed_ms"), F.col("ts").cast("timestamp").alias("ts"))


def mon_latency(spark, sf_dir):
    found = monitor.latency(_elapsed(spark, sf_dir), ("event_type",))
    return found.withColumns({"p50": F.round("p50", 6), "p99": F.round("p99", 6)})


def mon_lag(spark, sf_dir):
    rows = _elapsed(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.unix_millis("ts").alias("event_ms"),
        (F.unix_millis("ts") + F.floor(F.col("elapsed_ms") * 1000)).alias("ingest_ms"),
    )
    found = monitor.lag(rows, "event_ms", "ingest_ms", ("day",))
    return found.select(
        "day", "n", *[F.round(c, 6).alias(c) for c in ("avg_lag_ms", "p50_lag_ms", "p99_lag_ms")], "max_lag_ms"
    )


def mon_lag_windows(spark, sf_dir):
    rows = _elapsed(spark, sf_dir).select(
        "ts", (F.col("ts") + F.make_dt_interval(secs=F.floor("elapsed_ms").cast("decimal(18,6)"))).alias("ingest_ts")
    )
    found = monitor.lag_windows_exact(rows, "ts", "ingest_ts", "1 hour")
    rounded = [F.round(c, 6).alias(c) for c in ("avg_lag_ms", "p50_lag_ms", "p99_lag_ms")]
    return found.select(F.unix_millis("window").alias("window_ms"), "n", *rounded, "max_lag_ms")


def mon_latency_rollup(spark, sf_dir):
    """Sketches per minute, merged to hours and then to days."""
    minutes = rollups.distributions(_elapsed(spark, sf_dir), "ts", "elapsed_ms", ("event_type",))
    hours = rollups.rolled_up(minutes, ("event_type",), "1 hour")
    days = rollups.quantiles(rollups.rolled_up(hours, (), "1 day"), {"p50": 0.5, "p99": 0.99})
    return days.select(F.unix_millis("start").alias("start_ms"), "n", "highest", F.round("mean", 6).alias("mean"), "p50", "p99")


def mon_log_counts(spark, sf_dir):
    counts = rollups.log_counts(monitor.log_fields(sample.service_logs(spark, sf_dir)))
    return rollups.errors(counts).join(rollups.outcomes(counts).withColumnRenamed("total", "outcomes"), "event", "left")


def mon_cost(spark, sf_dir):
    docs = sample.table(spark, sf_dir, "documents")
    count = tx.word_count("text")
    usage = docs.select(
        F.when(F.col("doc_id") % 7 == 0, None)
        .when(F.col("doc_id") % 5 == 0, "unpriced")
        .when(F.col("doc_id") % 3 == 0, "small")
        .otherwise("large")
        .alias("model"),
        (count + 100).alias("tokens_in"),
        F.least(count, F.lit(200)).alias("tokens_out"),
    )
    return monitor.cost(usage, monitor.token_prices(spark))


QUERIES = {
    "validate_split": validate_split,
    "quarantine_counts": quarantine_counts,
    "quarantine_errors": quarantine_errors,
    "typed_messages": typed_messages,
    "coerce_lists": coerce_lists,
    "extract_symbols": extract_symbols,
    "clean_steps": clean_steps,
    "clean_articles": clean_articles,
    "clean_size": clean_size,
    "fallback_content": fallback_content,
    "summary_routing": summary_routing,
    "summarize_extractive": summarize_extractive,
    "reused_summaries": reused_summaries,
    "store_summaries": store_summaries,
    "summarized_records": summarized_records,
    "summarized_lines": summarized_lines,
    "prompts": article_prompts,
    "html_prompts": html_prompts,
    "word_count": word_count,
    "preview": preview,
    "ticker_records": ticker_records,
    "document_records": document_records,
    "by_ticker": by_ticker,
    "ndjson_lines": ndjson_lines,
    "assign_windows": assign_windows,
    "rotate_files": rotate_files,
    "rewrite_archive": rewrite_archive,
    "lenient_lines": lenient_lines,
    "bad_line_numbers": bad_line_numbers,
    "legacy_backfill": legacy_backfill,
    "legacy_backfill_html": legacy_backfill_html,
    "migration_failures": migration_failures,
    "migration_stats": migration_stats,
    "log_fields": log_fields,
    "mon_outcomes": mon_outcomes,
    "mon_success_rate": mon_success_rate,
    "mon_retries": mon_retries,
    "mon_multi_ticker": mon_multi_ticker,
    "mon_multi_ticker_articles": mon_multi_ticker_articles,
    "mon_per_minute": mon_per_minute,
    "mon_errors": mon_errors,
    "mon_latency": mon_latency,
    "mon_lag": mon_lag,
    "mon_lag_windows": mon_lag_windows,
    "mon_latency_rollup": mon_latency_rollup,
    "mon_log_counts": mon_log_counts,
    "mon_rotation": mon_rotation,
    "mon_cost": mon_cost,
}
