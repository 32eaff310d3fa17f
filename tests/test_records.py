import json

from pyspark.sql import functions as F

from newsflow.operators import ingest, records
from newsflow.plans.pipeline import articles_to_records
from newsflow.schema import RECORD

from .messages import DROP, frame, message


def output(spark, *raws):
    articles = ingest.accepted(ingest.parse_messages(frame(spark, *raws)))
    return articles_to_records(articles, None)


def test_single(spark):
    rows = output(spark, message()).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.ticker, row.news_id, row.timestamp, row.action) == ("LHBK", 4711, 1935817689000, "Created")
    assert "doubled" in row.content and "<" not in row.content


def test_two_tickers_share_everything_else(spark):
    raw = message({"id": 12}, securities=[{"symbol": "AAPL"}, {"symbol": "MSFT"}])
    rows = output(spark, raw).orderBy("pos").collect()
    assert [r.ticker for r in rows] == ["AAPL", "MSFT"]
    assert {r.news_id for r in rows} == {12} and len({r.content for r in rows}) == 1


def test_repeated_ticker_gives_repeated_rows(spark):
    assert output(spark, message(securities=["A", "A"])).count() == 2


def test_no_securities(spark):
    assert output(spark, message(securities=[])).count() == 0


def test_defaults(spark):
    rows = (
        output(
            spark,
            message({"id": 1}, body=None, securities=["TEST"]),
            message({"id": 2}, authors=None, channels=None),
            message({"id": 3, "action": DROP}),
            message({"id": 4, "action": ""}, body=None, teaser=None, title=None),
            message({"id": 5, "action": "Updated"}, body=" ", teaser="<p> </p>"),
        )
        .orderBy("news_id")
        .collect()
    )
    assert rows[0].content == "More flour from the coast"
    assert rows[1].authors == [] and rows[1].channels == []
    assert [r.action for r in rows[2:]] == ["Created", "Created", "Updated"]
    assert rows[3].content == "No content available" and rows[4].content == rows[4].title


def test_ndjson_has_every_key_in_order(spark):
    lines = records.to_ndjson(output(spark, message(updated_at=None, url=None, title='q"é\n')))
    row = lines.first()
    value = json.loads(row.line)
    assert list(value) == RECORD.names
    assert type(value["timestamp"]) is int and value["updated_at"] is None and value["url"] is None
    assert value["created_at"] == "2031-05-06T06:55:00Z" and value["title"] == 'q"é\n'
    assert row.bytes == len((row.line + "\n").encode()) and "\n" not in row.line


def test_by_ticker(spark):
    rows = output(spark, message(securities=["A", "B"]), message(securities=["B"]))
    assert records.by_ticker(rows, "B").count() == 2


def test_choose_content_prefers_the_summary(spark):
    articles = ingest.accepted(ingest.parse_messages(frame(spark, message({"id": 1}), message({"id": 2}))))
    cleaned = records.clean_articles(articles)
    summary = F.when(F.col("id") == 1, F.lit("short")).otherwise(F.lit(""))
    rows = records.choose_content(cleaned, summary).orderBy("id").collect()
    assert rows[0].content == "short" and rows[1].content.startswith("Bakers said")
