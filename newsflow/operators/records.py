"""Article rows to output rows: cleaning, content choice, one row per ticker, serialization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as tx
from ..functions import times
from ..functions.tickers import primary_ticker

DEFAULT_ACTION = "Created"
# What the fan-out needs of an article.
SOURCE_COLUMNS = (
    "timestamp",
    "id",
    "action",
    "title",
    "content",
    "authors",
    "url",
    "channels",
    "created_at",
    "updated_at",
    "tickers",
)


def clean_articles(articles: DataFrame) -> DataFrame:
    """Add ``body_clean``, ``teaser_clean`` and ``primary_ticker``."""
    return articles.select(
        "*",
        tx.clean_html("body").alias("body_clean"),
        tx.clean_html("teaser").alias("teaser_clean"),
        primary_ticker(F.col("tickers")).alias("primary_ticker"),
    )


def choose_content(
    cleaned: DataFrame, summary: Column | None = None, fallback_chars: int | None = tx.FALLBACK_CHARS
) -> DataFrame:
    """Add ``content``: the summary, or where there is none the fallback text (see ``text.fallback_content``)."""
    chosen = tx.fallback_content("body_clean", "teaser_clean", "title", fallback_chars)
    if summary is not None:
        chosen = F.coalesce(F.nullif(summary, F.lit("")), chosen)
    return cleaned.withColumn("content", chosen)


def explode_tickers(articles: DataFrame, *keep: str) -> DataFrame:
    """One output row per ticker, repeats included; columns of ``schema.RECORD``, then ``keep``, ``pos``.

    Run it last: everything before it works once per article, whatever the number of tickers.
    """
    values = {
        "timestamp": times.epoch_millis(F.col("timestamp")),
        "ticker": F.col("_ticker"),
        "news_id": F.col("id"),
        "action": F.coalesce(F.nullif(F.col("action"), F.lit("")), F.lit(DEFAULT_ACTION)),
        "authors": F.coalesce("authors", F.array().cast("array<string>")),
        "channels": F.coalesce("channels", F.array().cast("array<string>")),
    }
    # Only what a record needs is carried through the explode.
    needed = articles.select(*SOURCE_COLUMNS, *keep)
    exploded = needed.select("*", F.posexplode("tickers").alias("pos", "_ticker"))
    return exploded.select(*[values.get(n, F.col(n)).alias(n) for n in schema.RECORD.names], *keep, "pos")


def by_ticker(records: DataFrame, ticker: str) -> DataFrame:
    """Rows of one ticker; compares untransformed so that it is pushed to the scan of stored records."""
    return records.where(F.col("ticker") == ticker)


def to_ndjson(records: DataFrame) -> DataFrame:
    """Add ``line`` (all record fields, nulls written) and ``bytes`` (its size with the line feed)."""
    shown = {name: times.iso_text(F.col(name)) for name in ("created_at", "updated_at")}
    fields = F.struct(*[shown.get(n, F.col(n)).alias(n) for n in schema.RECORD.names])
    line = F.to_json(fields, {"ignoreNullFields": "false"})
    return records.withColumn("line", line).withColumn("bytes", (F.octet_length("line") + 1).cast("bigint"))
