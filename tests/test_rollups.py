import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newsflow.operators import monitor, rollups
from newsflow.operators.totals import exact_percentiles
from newsflow.schema import SERVICE_LOG
from newsflow.streaming.rollups import add_counts, read_counts, start_rollups

START = datetime(2025, 10, 2, 12, 0)


def calls(spark, n, seed=1, minutes=180):
    rng = random.Random(seed)
    rows = [(START + timedelta(seconds=rng.randrange(60 * minutes)), rng.choice(["a", "b", None]), rng.lognormvariate(5, 1)) for _ in range(n)]
    rows += [(None, "a", 1.0), (START, "a", None)]
    return spark.createDataFrame(rows, "time timestamp, model string, ms double").repartition(5)


def test_rollup_of_rollups_equals_one_over_the_rows(spark):
    rows = calls(spark, 2000)
    minutes = rollups.distributions(rows, "time", "ms", ("model",))
    assert minutes.count() > 300
    ranks = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    shown = lambda r: sorted(map(repr, (tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in rollups.quantiles(r, ranks).collect())))
    hours = rollups.rolled_up(minutes, ("model",), "1 hour")
    assert shown(rollups.rolled_up(hours, (), "1 day")) == shown(rollups.distributions(rows, "time", "ms", (), "1 day"))
    assert shown(hours) == shown(rollups.distributions(rows, "time", "ms", ("model",), "1 hour"))


def test_rank_error_of_merged_sketches(spark):
    rows = calls(spark, 30_000, 2)
    known = rows.dropna(subset=["time", "ms"])
    merged = rollups.rolled_up(rollups.distributions(rows, "time", "ms", (), k=200), (), "1 day", 200)
    got = rollups.quantiles(merged, {f"p{p}": p / 100 for p in (5, 50, 95)}).first()
    n = known.count()
    exact = exact_percentiles(known.withColumn("g", F.lit(1)), ["g"], "ms", {"p50": 0.5}, maximum="top").first()
    assert got.n == n == exact.n and got.highest == exact.top
    for p in (5, 50, 95):
        rank = known.where(F.col("ms") <= got[f"p{p}"]).count() / n
        assert abs(rank - p / 100) < 0.04
    assert len(merged.first().sketch) < 20_000


def test_sketches_on_a_stream(spark, tmp_path):
    rows = calls(spark, 500, 3).dropna(subset=["time", "ms"])
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    rows.limit(1).select((F.lit(START) + F.expr("INTERVAL 2 DAYS")).cast("timestamp").alias("time"), "model", "ms").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = rollups.distributions(stream.withWatermark("time", "1 day"), "time", "ms", (), "1 hour")
    query = found.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"), "parquet")
    query.awaitTermination()
    got = rollups.quantiles(spark.read.parquet(str(tmp_path / "out")), {"p50": 0.5}).select("start", "n", "p50")
    wanted = rollups.quantiles(rollups.distributions(rows, "time", "ms", (), "1 hour"), {"p50": 0.5}).select("start", "n", "p50")
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def log_line(rng, at):
    message, level = rng.choice([
        ("bedrock-throttled ticker=A attempt=2 retrying_in=1s", "WARNING"), ("bedrock-throttled ticker=B attempt=1 retrying_in=1s", "WARNING"),
        ("article-summarized ticker=A words=10 attempt=1", "DEBUG"), ("summarization-failed news_id=1 using-body-fallback", "ERROR"),
        ("multi-ticker-article news_id=7 tickers=3", "DEBUG"), ("multi-ticker-article news_id=8 tickers=5", "DEBUG"), ("ws-error reason=closed reconnecting_in=2s", "ERROR"),
    ])
    return {"level": level, "logger": rng.choice(["app.a", "app.b"]), "message": message, "time": at and at.strftime("%Y-%m-%dT%H:%M:%S+0000")}


def test_live_rollups_equal_batch_and_count_late_lines(spark, tmp_path):
    rng = random.Random(5)
    landing = tmp_path / "logs"
    landing.mkdir()
    late = 0
    for k in range(4):
        lines = [log_line(rng, START + timedelta(minutes=15 * k, seconds=rng.randrange(600))) for _ in range(80)] + [log_line(rng, None)]
        if k == 3:
            lines += [log_line(rng, START + timedelta(seconds=rng.randrange(600))) for _ in range(11)]
            late = 11
        (landing / f"{k}.json").write_text("\n".join(map(json.dumps, lines)) + "\n")
    stream = spark.readStream.schema(SERVICE_LOG).option("maxFilesPerTrigger", 1).json(str(landing))
    out = str(tmp_path / "out")
    for _ in range(2):  # a second start finds nothing new
        start_rollups(stream, out, str(tmp_path / "state"), available_now=True).awaitTermination()
    logs = spark.read.schema(SERVICE_LOG).json(str(landing))
    fields, counts = monitor.log_fields(logs), read_counts(spark, out)
    pairs = [
        (monitor.outcomes(fields), rollups.outcomes(counts)), (monitor.retries(fields), rollups.retries(counts)), (monitor.errors(fields), rollups.errors(counts)),
        (monitor.multi_ticker_log(fields), rollups.multi_ticker(counts)), (monitor.per_minute(fields.where("time IS NOT NULL")), rollups.per_minute(counts)),
    ]
    for batch, live in pairs:
        assert sorted(map(repr, map(tuple, batch.collect()))) == sorted(map(repr, map(tuple, live.select(batch.columns).collect())))
    assert counts.agg(F.sum("late")).first()[0] == late and counts.agg(F.sum("lines")).first()[0] == logs.count()
    # A batch that runs again replaces its counts (and the files that ``counts`` reads).
    before = counts.agg(F.sum("lines"), F.sum("late")).first()
    last = logs.where(F.col("_metadata.file_name") == "3.json")
    add_counts(last, out, 3)
    again = read_counts(spark, out)
    assert again.agg(F.sum("lines"), F.sum("late")).first() == before
