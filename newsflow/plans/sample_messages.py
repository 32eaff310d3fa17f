"""News messages, service logs and archives derived from the driver's tables.

Each function is mirrored by a SQL view in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The time of an article without an event, and the first sentence or line of a text.
NO_EVENT = "2024-01-01 00:00:00"
FIRST_SENTENCE = r"^[^.!?\n]*[.!?]?"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticker(key: Column, factor: int) -> Column:
    return F.concat(F.lit("T"), (key * factor % 20).cast("string"))


def _title(text: str) -> Column:
    return F.regexp_extract(text, FIRST_SENTENCE, 0).alias("title")


def _event_time(ts: Column) -> Column:
    return ts.cast("timestamp")


def articles(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    """One article per page or document, with the time and type of the event of the same number.

    Without such an event the time is ``NO_EVENT`` and the type ``none``.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    if source == "pages":
        base = table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("key"),
            "url",
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
            F.col("html").alias("body"),
        )
    else:
        base = table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("key"),
            F.concat(F.lit("https://news.example/"), "doc_id").alias("url"),
            _title("text"),
            F.col("text").alias("body"),
        )
    key = F.col("key")
    joined = base.join(events, F.col("event_id") == key, "left")
    rows = joined.withColumn("event_type", F.coalesce("event_type", F.lit("none")))
    stamp = _event_time(F.coalesce("ts", F.lit(NO_EVENT).cast("timestamp_ntz")))
    return rows.select(
        key,
        stamp.alias("ingest_ts"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(key % 4 == 0, "Created").when(key % 4 == 1, "Updated").when(key % 4 == 2, "").alias("action"),
        "title",
        "body",
        F.when(key % 3 != 0, F.concat(F.lit("<p>"), "event_type", F.lit("</p>"))).alias("teaser"),
        "url",
        F.when(key % 3 == 1, F.array(F.lit("Ann")))
        .when(key % 3 == 2, F.array(F.lit("Ann"), F.concat(F.lit("Bo "), key.cast("string"))))
        .alias("authors"),
        F.when(key % 5 == 1, F.array(F.lit("News")))
        .when(key % 5 == 2, F.array(F.lit("News"), F.lit("Markets")))
        .when(key % 5 == 3, F.array(F.lit("Solo")))
        .alias("channels"),
        F.date_format(stamp - F.expr("INTERVAL 5 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.when(key % 7 != 0, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("updated_at"),
        _securities(key).alias("securities"),
    )


def _securities(key: Column) -> Column:
    """JSON text of the securities, in six shapes."""

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    return (
        F.when(key % 6 == 0, F.lit("[]"))
        .when(key % 6 == 1, text('[{"symbol":"', _ticker(key, 1), '","exchange":"NYSE","primary":true}]'))
        .when(key % 6 == 2, text('["  ', _ticker(key, 2), '  "]'))
        .when(key % 6 == 3, text('[{"symbol":"', _ticker(key, 1), '"},"', _ticker(key, 2), '"]'))
        .when(key % 6 == 4, text('[{"exchange":"NYSE"},{"symbol":"', _ticker(key, 3), '"},5,null]'))
        .otherwise(text('"', _ticker(key, 5), '"'))
    )


def messages(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    """The articles as raw JSON messages: ``key``, ``ingest_ts``, ``raw``. Channel Solo is sent as text."""
    content = F.to_json(
        F.struct(
            F.col("key").alias("id"), F.lit(1).alias("revision_id"), F.lit("story").alias("type"),
            "title", "body", "teaser", "url", "authors", "channels", "created_at", "updated_at",
        ),
        {"ignoreNullFields": "false"},
    )
    content = F.replace(content, F.lit('"channels":["Solo"]'), F.lit('"channels":"Solo"'))
    raw = F.concat(
        F.lit('{"api_version":"websocket/v1","kind":"News/v1","data":{"id":'), F.col("key").cast("string"),
        F.lit(',"timestamp":"'), F.col("timestamp"),
        F.lit('","action":'), F.coalesce(F.concat(F.lit('"'), "action", F.lit('"')), F.lit("null")),
        F.lit(',"content":'), F.regexp_replace(content, r"\}$", ""),
        F.lit(',"securities":'), F.col("securities"), F.lit("}}}"),
    )
    return articles(spark, sf_dir, source).select("key", "ingest_ts", raw.alias("raw"))


def faulty_messages(spark: SparkSession, sf_dir: str, source: str = "pages") -> DataFrame:
    """The messages, most of them damaged in one of twelve ways by ``key % 16``."""
    raw, key = F.col("raw"), F.col("key") % 16

    def with_head(fields: str) -> Column:
        return F.regexp_replace(raw, '"data":.*"content"', f'"data":{{{fields},"content"')

    damaged = (
        F.when(key == 0, F.lit("{bad"))
        .when(key == 1, F.lit("5"))
        .when(key == 2, F.regexp_replace(raw, r'"data":\{"id":[0-9]+,', '"data":{'))
        .when(key == 3, F.regexp_replace(raw, '"type":"story"', '"type":7'))
        .when(key == 4, F.regexp_replace(raw, '"url":"[^"]*"', '"url":"u","authors_unknown":1'))
        .when(key == 5, with_head('"id":"12","timestamp":1759428000'))
        .when(key == 6, with_head('"id":1.5,"timestamp":1759428000'))
        .when(key == 7, F.concat(raw, F.lit(" x")))
        .when(key == 8, F.regexp_replace(raw, '"revision_id":1', '"revision_id":"one"'))
        .when(key == 9, with_head('"id":1.0,"timestamp":"nope"'))
        .when(key == 10, F.regexp_replace(raw, '"revision_id":1', '"revision_id":true'))
        .when(key == 11, F.lit("[]"))
        .otherwise(raw)
    )
    return messages(spark, sf_dir, source).select("key", "ingest_ts", damaged.alias("raw"))


def service_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    kind, number, user = F.col("event_type"), F.col("event_id").cast("string"), F.col("user_id").cast("string")
    odd = F.col("event_id") % 2 == 1
    message = (
        F.when(kind == "error", text("bedrock-throttled ticker=T", user, " attempt=", k % 3 + 1, " retrying_in=", k % 3 + 1, "s"))
        .when(kind == "click", text("article-summarized ticker=T", user, " words=", k, " attempt=1"))
        # One line per failed attempt, then one for the article.
        .when((kind == "view") & odd, text("article-summarization-failed ticker=T", user, " error_code=Code", k % 3, " attempt=", k % 3 + 1))
        .when(kind == "view", text("summarization-failed news_id=", number, " using-body-fallback"))
        .when((kind == "signup") & odd, text("ws-error reason=closed", k % 2, " reconnecting_in=", k % 5 + 1, ".5s"))
        .when(kind == "signup", text("multi-ticker-article news_id=", number, " tickers=", k % 4 + 2))
        .otherwise(text("writing record news_id=", number, " ticker=T", user))
    )
    level = F.when(kind == "error", "WARNING").when((kind == "view") | (kind == "signup") & odd, "ERROR").otherwise("DEBUG")
    logger = F.when(kind.isin("error", "click") | (kind == "view") & odd, "app.summarizer").otherwise("app.client")
    return events.select(
        level.alias("level"),
        logger.alias("logger"),
        message.alias("message"),
        F.date_format(_event_time(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss'+0000'").alias("time"),
        F.lit(None).cast("string").alias("exc_info"),
    )


def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an archive line in one of eight shapes by ``event_id % 8``."""
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    stamp = _event_time(F.col("ts"))
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rest = F.concat(F.lit(',"n":'), key.cast("string"), F.lit(',"type":"'), "event_type", F.lit('"}'))

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    line = (
        F.when(key % 8 == 1, text('{"timestamp":', F.unix_millis(stamp).cast("string"), rest))
        .when(key % 8 == 2, text('{"timestamp": "', iso, '+05:00"', rest))
        .when(key % 8 == 3, text('{"meta":{"timestamp":"', iso, 'Z"}', rest))
        .when(key % 8 == 4, text('{"meta":{"timestamp":"', iso, 'Z"},"timestamp":"', iso, 'Z"', rest))
        .when(key % 8 == 5, text('{"timestamp":"', iso, 'Z"'))
        .when(key % 8 == 6, text('{"timestamp":"soon"', rest))
        .when(key % 8 == 7, F.lit(""))
        .otherwise(text('{"timestamp":"', iso, 'Z"', rest))
    )
    return events.select(key.alias("key"), line.alias("line"))


def legacy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a legacy archive line of its source's file; some unusable by ``doc_id % 10``."""
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    good = F.to_json(
        F.struct(
            key.alias("news_id"),
            F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
            F.when(key % 10 != 1, F.concat(F.lit("T"), (key % 20).cast("string"))).alias("ticker"),
            _title("text"),
            F.col("text").alias("body"),
        )
    )
    wrong_time = F.regexp_replace(good, "2024-01-01T00", "2024-99-01T00")
    line = F.when(key % 10 == 0, F.lit("{bad")).when(key % 10 == 2, wrong_time).otherwise(good)
    return docs.select(F.col("source").alias("path"), key.alias("key"), line.alias("line"))
