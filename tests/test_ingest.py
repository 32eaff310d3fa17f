from datetime import datetime

import pytest

from newsflow.operators import ingest
from newsflow.schema import DECODE_FAILED, NO_SECURITIES, VALIDATION_FAILED

from .messages import DROP, frame, message


def parsed(spark, *raws):
    return ingest.parse_messages(frame(spark, *raws)).orderBy("key").collect()


def test_single_message(spark):
    (row,) = parsed(spark, message())
    assert row.reason is None
    assert (row.id, row.content_id, row.tickers) == (4711, 99, ["LHBK"])
    assert row.timestamp == datetime(2031, 5, 6, 7, 8, 9)
    assert row.authors == ["Ida Quill", "Tom Reed"] and row.channels == ["Food", "Regional"]


SYMBOLS = [
    ([{"symbol": "TSLA"}], ["TSLA"]),
    (["AAPL"], ["AAPL"]),
    (["  MSFT  "], ["MSFT"]),
    ([{}, {"exchange": "NYSE"}, "", "   ", None], []),
    ([{"symbol": ""}, {"symbol": "TSLA"}], ["TSLA"]),
    ([{"symbol": "TSLA"}, "AAPL", {"exchange": "NYSE"}, "  MSFT  "], ["TSLA", "AAPL", "MSFT"]),
    ([{"symbol": 5}, 5, True, ["A"], 1.5, {"symbol": None}, {"symbol": {"symbol": "X"}}], []),
    ([{"symbol": " A "}, {"symbol": "   "}], [" A ", "   "]),
    (["A", "A"], ["A", "A"]),
    (None, []),
    (DROP, []),
    ("AAPL", ["AAPL"]),
    ({"symbol": "X"}, ["X"]),
    (7, []),
]


def test_symbols(spark):
    rows = parsed(spark, *[message(securities=s) for s, _ in SYMBOLS])
    assert [r.tickers for r in rows] == [expected for _, expected in SYMBOLS]
    assert [r.reason for r in rows] == [None if e else NO_SECURITIES for _, e in SYMBOLS]


REJECTED = {
    "{bad": DECODE_FAILED,
    "": DECODE_FAILED,
    message() + " x": DECODE_FAILED,
    message() + message(): DECODE_FAILED,
    message() + "]": DECODE_FAILED,
    message() + ",1": DECODE_FAILED,
    '{"a":NaN}': DECODE_FAILED,
    message(title="x").replace('"x"', '"\\ud800"'): DECODE_FAILED,
    "5": VALIDATION_FAILED,
    "[]": VALIDATION_FAILED,
    "{}": VALIDATION_FAILED,
    "null": VALIDATION_FAILED,
    '{"data":7}': VALIDATION_FAILED,
    message({"id": DROP}): VALIDATION_FAILED,
    message({"id": None}): VALIDATION_FAILED,
    message({"id": 1.5}): VALIDATION_FAILED,
    message({"id": "1.5"}): VALIDATION_FAILED,
    message({"id": "x"}): VALIDATION_FAILED,
    message({"timestamp": DROP}): VALIDATION_FAILED,
    message({"timestamp": "nope"}): VALIDATION_FAILED,
    message({"timestamp": True}): VALIDATION_FAILED,
    message({"content": DROP}): VALIDATION_FAILED,
    message({"content": 5}): VALIDATION_FAILED,
    message({"content": {}}): NO_SECURITIES,
    message({"action": 1}): VALIDATION_FAILED,
    message(title=5): VALIDATION_FAILED,
    message(authors=[5]): VALIDATION_FAILED,
    message(authors=[None]): VALIDATION_FAILED,
    message(authors={"a": 1}): VALIDATION_FAILED,
    message(channels=5): VALIDATION_FAILED,
    message(revision_id="one"): VALIDATION_FAILED,
    message(created_at="2025-13-02"): VALIDATION_FAILED,
    message(securities=[]): NO_SECURITIES,
}


def test_rejected(spark):
    rows = parsed(spark, *REJECTED)
    assert {r.raw: r.reason for r in rows} == REJECTED


def test_quarantine_and_accepted_cover_everything(spark):
    found = ingest.parse_messages(frame(spark, *REJECTED, message()))
    assert ingest.accepted(found).count() == 1
    assert ingest.quarantine(found).count() == len(REJECTED)


def test_coerced_values(spark):
    rows = parsed(
        spark,
        message({"id": "123"}, authors="Bob", channels=None),
        message({"id": 1.0}, authors=DROP),
        message({"id": True, "extra": {"a": 1}}),
        message({"id": " +1_000.0 "}),
        '{"data":{"id":1,"id":2,"timestamp":1,"content":{"securities":["A"]}}}',
        message(title="\U0001f600 é"),
    )
    assert [r.reason for r in rows] == [None] * 6
    assert [r.id for r in rows] == [123, 1, 1, 1000, 2, 4711]
    assert rows[0].authors == ["Bob"] and rows[0].channels == [] and rows[1].authors == []
    assert rows[5].title == "\U0001f600 é"


# Expected values in seconds since the epoch; None is rejected.
TIMESTAMPS = [
    ("2025-10-02T18:00:00Z", 1759428000),
    ("2025-10-02 18:00:00", 1759428000),
    ("2025-10-02t18:00:00z", 1759428000),
    ("2025-10-02_18:00:00", 1759428000),
    ("2025-10-02T18:00", 1759428000),
    ("2025-10-02", 1759363200),
    ("2025-10-02T18:00:00.123456789Z", 1759428000.123456),
    ("2025-10-02T18:00:00,5Z", 1759428000.5),
    ("2025-10-02T18:00:00+05:00", 1759410000),
    ("2025-10-02T18:00:00-0530", 1759447800),
    ("2025-10-02T18:00:00+23:59", 1759341660),
    ("2025-10-02T18:00:00−05:00", 1759446000),
    ("1759428000", 1759428000),
    ("+1759428000.5", 1759428000.5),
    ("1759428000000", 1759428000),
    ("20251002", 20251002),
    (1759428000, 1759428000),
    (1759428000.5, 1759428000.5),
    (1759428000123.5, 1759428000.1235),
    (20000000000, 20000000000),
    (20000000001, 20000000.001),
    (-5, -5),
    ("2025-10-02T18", None),
    ("2025-10-02T18:00:00+05", None),
    ("2025-10-02T18:00:00 +05:00", None),
    ("2025-10-02T24:00:00Z", None),
    ("2025-10-02T23:59:60Z", None),
    ("2025-10-02T18:00:00.Z", None),
    ("2025-02-29", None),
    ("2025-1-2", None),
    (" 2025-10-02", None),
    ("2025-10-02T18:00:00Z\n", None),
    ("0000-01-01", None),
    ("1e9", None),
    ("", None),
    ("-", None),
    (1e30, None),
    (253402300800000, None),
    ([1], None),
]


def test_timestamps(spark):
    from pyspark.sql import functions as F

    raws = [message({"timestamp": value}) for value, _ in TIMESTAMPS]
    found = ingest.parse_messages(frame(spark, *raws)).orderBy("key")
    rows = found.select(F.unix_micros("timestamp").alias("us"), "reason").collect()
    for (value, expected), row in zip(TIMESTAMPS, rows):
        if expected is None:
            assert (row.us, row.reason) == (None, VALIDATION_FAILED), value
        else:
            assert row.reason is None and row.us == pytest.approx(expected * 1e6, abs=0.5), value


def test_message_beyond_the_parser_has_its_own_reason(spark):
    rows = ingest.parse_messages(frame(spark, message(body="x" * 20_500_000), message(body="x" * 1000))).select("reason").collect()
    assert [r.reason for r in rows] == ["too-large", None]


ERRORS = [
    (message(), None),
    ("{bad", None),
    (message(securities=[]), None),
    ("5", [("$", "BIGINT", "object")]),
    ('{"data":7}', [("data.id", "missing", "integer"), ("data.timestamp", "missing", "time"), ("data.content", "missing", "object")]),
    (message({"content": DROP}), [("data.content", "missing", "object")]),
    (message({"id": DROP}), [("data.id", "missing", "integer")]),
    (message({"id": None, "timestamp": True}), [("data.id", "missing", "integer"), ("data.timestamp", "BOOLEAN", "time")]),
    (message({"id": 1.5}, title=5, authors=[5, "A"]), [("data.id", "DECIMAL", "integer"), ("data.content.title", "BIGINT", "text"), ("data.content.authors", "ARRAY", "texts")]),
    (message(channels={"a": 1}), [("data.content.channels", "OBJECT", "texts")]),
]


def test_errors_name_every_field_at_fault(spark):
    frames = frame(spark, *[raw for raw, _ in ERRORS])
    rows = ingest.parse_messages(frames).select("raw", "reason", "errors").collect()
    got = {r.raw: r["errors"] and {tuple(e) for e in r["errors"]} for r in rows}
    assert got == {raw: errors and set(errors) for raw, errors in ERRORS}
    kept = ingest.quarantine(ingest.parse_messages(frames)).collect()
    assert all((r["errors"] is not None) == (r.reason == VALIDATION_FAILED) for r in kept)
