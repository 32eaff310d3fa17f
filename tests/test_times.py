from datetime import datetime, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsflow.functions import times

MOMENTS = st.datetimes(min_value=datetime(1950, 1, 1), max_value=datetime(2100, 1, 1))


@settings(max_examples=8, deadline=None)
@given(st.lists(MOMENTS, min_size=200, max_size=300))
def test_epoch_millis_equals_float_arithmetic(spark, moments):
    moments += [m.replace(microsecond=m.microsecond // 1000 * 1000) for m in moments]
    micros = [(i, int((m - datetime(1970, 1, 1)).total_seconds() // 1) * 10**6 + m.microsecond) for i, m in enumerate(moments)]
    df = spark.createDataFrame(micros, "i int, us bigint")
    found = df.select("i", times.epoch_millis(F.timestamp_micros("us")).alias("ms")).orderBy("i").collect()
    expected = [int(m.replace(tzinfo=timezone.utc).timestamp() * 1000) for m in moments]
    assert [r.ms for r in found] == expected


WINDOWS = [
    ("2025-10-02 18:07:31", 30, "20251002_1800-20251002_1829"),
    ("2025-10-02 18:29:59.5", 30, "20251002_1800-20251002_1829"),
    ("2025-10-02 18:30:00", 30, "20251002_1830-20251002_1859"),
    ("2025-10-02 18:50:10", 45, "20251002_1845-20251002_1929"),
    ("2025-10-02 18:50:10", 120, "20251002_1800-20251002_1959"),
    ("2025-12-31 23:59:59", 15, "20251231_2345-20251231_2359"),
    ("2025-12-31 23:59:59", 45, "20251231_2345-20260101_0029"),
]


def test_windows(spark):
    for moment, minutes, label in WINDOWS:
        ts = F.lit(moment).cast("timestamp")
        start = times.window_start(ts, minutes)
        row = spark.range(1).select(times.window_label(start, minutes).alias("part")).first()
        assert row.part == label, (moment, minutes)


def test_iso_text(spark):
    values = ["2025-10-02 17:55:00", "2025-10-02 17:55:00.5", "0025-01-01 00:00:00.000001"]
    found = [spark.range(1).select(times.iso_text(F.lit(v).cast("timestamp")).alias("t")).first().t for v in values]
    assert found == ["2025-10-02T17:55:00Z", "2025-10-02T17:55:00.500000Z", "0025-01-01T00:00:00.000001Z"]
