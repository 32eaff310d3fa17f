"""What the plans must look like, whatever the size of the data."""

import re

from newsflow.operators import archive, enrich, ingest, monitor, records
from newsflow.plans import sample_messages as sample
from newsflow.plans.pipeline import articles_to_records
from newsflow.sources import read_archive, read_messages

from .messages import message


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark, tmp_path):
    (tmp_path / "in.json").write_text(message() + "\n")
    return read_messages(spark, str(tmp_path / "in.json"))


def test_records_need_no_shuffle_and_two_python_stages_at_most(spark, tmp_path):
    articles = ingest.accepted(ingest.parse_messages(landed(spark, tmp_path)))
    text = plan(articles_to_records(articles, enrich.LeadingSentences()))
    assert "Exchange" not in text
    # One for both HTML texts, one for the service.
    assert text.count("ArrowEvalPython") == 2


def test_tickerless_messages_stop_before_python(spark, tmp_path):
    articles = ingest.accepted(ingest.parse_messages(landed(spark, tmp_path)))
    lines = plan(records.clean_articles(articles)).splitlines()
    python = next(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
    dropped = next(i for i, line in enumerate(lines) if re.search(r"Filter .*isnull\(reason", line))
    # Deeper in the plan means earlier.
    assert dropped > python


def test_reading_fields_happens_once(spark, tmp_path):
    text = plan(ingest.accepted(ingest.parse_messages(landed(spark, tmp_path))))
    filters = [line for line in text.splitlines() if re.search(r"\bFilter\b", line)]
    assert filters and not any("parseJson" in line or "schemaOfVariant" in line for line in filters)
    # Nor by the filter Spark infers for the fan-out, or by one of the user's.
    rows = articles_to_records(ingest.accepted(ingest.parse_messages(landed(spark, tmp_path))), None)
    text = plan(rows.where("news_id = 5"))
    assert sum("parseJson" in line for line in text.splitlines()) == 1


def test_rewrite_is_map_only(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text("{}\n")
    assert "Exchange" not in plan(archive.rewrite_lines(read_archive(spark, str(tmp_path))))


def test_scans_read_what_is_needed(spark):
    text = plan(monitor.outcomes(monitor.log_fields(sample.service_logs(spark, "/root/testdata/sf0.001"))))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,props:string>" in text


def test_ticker_filter_reaches_stored_records(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.createDataFrame([("A", 1)], "ticker string, news_id bigint").write.parquet(path)
    assert "EqualTo(ticker,A)" in plan(records.by_ticker(spark.read.parquet(path), "A"))


def test_rollups_aggregate_before_the_shuffle(spark):
    text = plan(monitor.retries(monitor.log_fields(sample.service_logs(spark, "/root/testdata/sf0.001"))))
    assert "partial_count" in text and text.index("Exchange") < text.index("partial_count")
