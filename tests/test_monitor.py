from pyspark.sql import functions as F

from newsflow.operators import monitor
from newsflow.sources import read_service_log

# Level, logger and message in the formats the service logs.
LOG = [
    ("DEBUG", "s", "article-summarized ticker=TSLA words=195 attempt=1"),
    ("DEBUG", "s", "html-summarized ticker=AAPL words=80 attempt=2"),
    ("INFO", "s", "summarized ticker=AAPL words=203 attempt=2"),
    ("WARNING", "s", "bedrock-throttled ticker=AAPL attempt=1 retrying_in=1s"),
    ("WARNING", "s", "bedrock-throttled ticker=AAPL attempt=2 retrying_in=2s"),
    ("ERROR", "s", "bedrock-error ticker=AAPL error_code=AccessDenied error_message=no attempt=1"),
    ("ERROR", "s", "article-summarization-failed ticker=TSLA attempt=3"),
    ("WARNING", "s", "Primary model m-1 not available, trying fallback model m-2"),
    ("WARNING", "c", "summarization-failed news_id=101 using-body-fallback"),
    ("DEBUG", "c", "writing record news_id=101 ticker=TSLA"),
    ("DEBUG", "c", "multi-ticker-article news_id=789 tickers=2"),
    ("DEBUG", "c", "ignored message id=5 reason=no-securities"),
    ("ERROR", "c", "decode-failed: invalid JSON from socket"),
    ("WARNING", "c", "ws-error error=gone reconnecting_in=1.5s"),
]


def fields(spark, tmp_path):
    rows = [(*r, f"2025-10-02T18:{i:02d}:00+0000") for i, r in enumerate(LOG)]
    df = spark.createDataFrame(rows, "level string, logger string, message string, time string")
    path = str(tmp_path / "log")
    df.write.mode("overwrite").json(path)
    return monitor.log_fields(read_service_log(spark, path))


def test_fields(spark, tmp_path):
    rows = fields(spark, tmp_path).orderBy("time").collect()
    assert [r.event for r in rows] == [
        "article-summarized", "html-summarized", "summarized", "bedrock-throttled", "bedrock-throttled", "bedrock-error",
        "article-summarization-failed", "model-switch", "summarization-failed", "writing record",
        "multi-ticker-article", "ignored message", "decode-failed", "ws-error",
    ]
    assert (rows[0].ticker, rows[0].words, rows[0].attempt, rows[0].news_id) == ("TSLA", 195, 1, None)
    assert rows[5].error_code == "AccessDenied" and rows[11].reason == "no-securities"
    assert [rows[i].wait_seconds for i in (3, 4, 13)] == [1.0, 2.0, 1.5]
    assert rows[9].news_id == 101 and rows[10].tickers == 2


def test_rollups(spark, tmp_path):
    f = fields(spark, tmp_path)
    assert {(r.event, r.total) for r in monitor.outcomes(f).collect()} == {
        ("article-summarized", 1), ("html-summarized", 1), ("summarized", 1),
        ("article-summarization-failed", 1), ("summarization-failed", 1),
    }
    assert monitor.success_rate(f).first()[:] == (3, 4, 0.75)
    assert monitor.retries(f).first()[:] == ("AAPL", 2, 1.5)
    assert monitor.multi_ticker_log(f).first()[:] == (1, 2.0, 2)
    found = {(r.logger, r.event): (r.total, r.errors, r.throttled, r.reconnects) for r in monitor.errors(f).collect()}
    assert found[("s", "bedrock-throttled")] == (2, 0, 2, 0) and found[("c", "ws-error")] == (1, 0, 0, 1)
    assert found[("c", "decode-failed")] == (1, 1, 0, 0)
    assert monitor.per_minute(f).count() == len(LOG)


def test_no_attempts_gives_no_rate(spark, tmp_path):
    none = fields(spark, tmp_path).where(F.col("event") == "writing record")
    assert monitor.success_rate(none).first()[:] == (0, 0, None)


def test_cost(spark):
    usage = spark.createDataFrame(
        [("large", 1000, 250), ("large", 1000, 250), ("small", 1000, 250)], "model string, tokens_in bigint, tokens_out bigint"
    )
    found = {r.model: (r.calls, r.cost_usd) for r in monitor.cost(usage, monitor.token_prices(spark)).collect()}
    assert found == {"large": (2, 0.0135), "small": (1, 0.000563)}


def test_lag(spark):
    rows = spark.createDataFrame([("h", 0, 10), ("h", 0, 20), ("h", 5, 35)], "w string, e bigint, i bigint")
    found = monitor.lag(rows, "e", "i", ("w",)).first().asDict()
    assert found == {"w": "h", "n": 3, "p50_lag_ms": 20.0, "p99_lag_ms": 29.8, "avg_lag_ms": 20.0, "max_lag_ms": 30}


def test_streaming_rollups_with_a_watermark(spark, tmp_path):
    from newsflow.operators.monitor import lag_windows, per_minute

    rows = [(f"2025-10-02 18:0{m}:30", f"2025-10-02 18:0{m}:{s}") for m in (1, 2, 9) for s in (40, 50)]
    typed = spark.createDataFrame(rows, "e string, i string").selectExpr("timestamp(e) e", "timestamp(i) i")
    path = str(tmp_path / "rows")
    typed.write.parquet(path)
    stream = spark.readStream.schema(typed.schema).parquet(path).withWatermark("i", "2 minutes")
    for name, build in (("lag", lambda df: lag_windows(df, "e", "i")), ("rate", lambda df: per_minute(df, "i"))):
        query = build(stream).writeStream.format("memory").queryName(name).outputMode("append")
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
    # The last window stays open: it is still within the watermark.
    assert [tuple(r)[1:] for r in spark.table("lag").orderBy("window").collect()] == [(2, 15000.0, 20000, 10000, 20000)] * 2
    assert [r.records for r in spark.table("rate").collect()] == [2, 2]
    batch = lag_windows(typed, "e", "i")
    assert batch.count() == 3


def test_unpriced_and_missing_models_stay(spark):
    usage = spark.createDataFrame([("small", 10, 1), ("other", 5, 1), (None, 4, 0)], "model string, tokens_in bigint, tokens_out bigint")
    found = {r.model: (r.calls, r.tokens_in, r.cost_usd is None) for r in monitor.cost(usage, monitor.token_prices(spark)).collect()}
    assert found == {"small": (1, 10, False), "other": (1, 5, True), None: (1, 4, True)}


def test_stream_percentiles_close_to_exact(spark):
    rows = spark.range(1000).selectExpr("timestamp_seconds(id) AS e", "timestamp_seconds(id + id % 97) AS i")
    sketch = {r.window: r for r in monitor.lag_windows(rows, "e", "i", "5 minutes").collect()}
    for r in monitor.lag_windows_exact(rows, "e", "i", "5 minutes").collect():
        assert (sketch[r.window].n, sketch[r.window].max_lag_ms) == (r.n, r.max_lag_ms)
        assert abs(sketch[r.window].p50_lag_ms - r.p50_lag_ms) <= 1000 and abs(sketch[r.window].avg_lag_ms - r.avg_lag_ms) < 1e-6
