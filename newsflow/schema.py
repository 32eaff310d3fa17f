"""Declared schemas of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())

# A validated message, one row per article. ``securities`` keeps mixed element types.
MESSAGE = T.StructType(
    [
        T.StructField("api_version", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("action", T.StringType()),
        T.StructField("content_id", T.LongType()),
        T.StructField("revision_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("teaser", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("authors", _TEXTS),
        T.StructField("channels", _TEXTS),
        T.StructField("securities", T.ArrayType(T.VariantType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# One output row per ticker, columns in the order they are serialized.
RECORD = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("news_id", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("authors", _TEXTS),
        T.StructField("url", T.StringType()),
        T.StructField("channels", _TEXTS),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SERVICE_LOG = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("level", "logger", "message", "time", "exc_info")]
)

# Why a raw message did not become records.
DECODE_FAILED = "decode-failed"
VALIDATION_FAILED = "validation-failed"
NO_SECURITIES = "no-securities"
TOO_LARGE = "too-large"
# Why a legacy row was not migrated, besides the first of these and missing fields.
WRONG_TYPE = "wrong-type"
