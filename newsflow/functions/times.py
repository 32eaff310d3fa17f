"""Epoch milliseconds, ISO text and ingest windows, as column expressions. All times are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
# Years 1 to 9999.
MIN_EPOCH_MILLIS = -62_135_596_800_000
MAX_EPOCH_MILLIS = 253_402_300_799_999
# Date, optional time (seconds and fraction optional), optional offset.
LENIENT_ISO = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})"
    r"(?:[Tt _]((?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]++)?)?)"
    r"(?:[Zz]|([+\-−])([01][0-9]|2[0-3]):?([0-5][0-9]))?)?\z"
)
# The frequent exact form of the above.
UTC_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-5][0-9](?:\.[0-9]{1,6})?Z\z"
WINDOW_LABEL = "yyyyMMdd_HHmm"
DEFAULT_WINDOW_MINUTES = 30
# ----------------------------------------------------------------------------------------------


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch: seconds as a double, times 1000, cut toward zero.

    The double arithmetic is deliberate. It can give one millisecond less than ``unix_millis`` on
    exact milliseconds, and existing archives hold values computed this way.
    """
    seconds = F.unix_micros(ts).cast("double") / F.lit(1e6)
    return (seconds * F.lit(1e3)).cast("bigint")


def lenient_timestamp(text: Column) -> Column:
    """Timestamp of ISO text in any of the accepted spellings; no offset means UTC; else NULL."""
    local = F.replace(F.rtrim(F.regexp_replace(text, LENIENT_ISO, "$1 $2")), F.lit(","), F.lit("."))
    local = F.when(F.length(local) == 16, F.concat(local, F.lit(":00"))).otherwise(local).try_cast("timestamp")
    offset = F.regexp_replace(text, LENIENT_ISO, "$3$4$5")
    minutes = F.substring(offset, 2, 2).try_cast("bigint") * 60 + F.substring(offset, 4, 2).try_cast("bigint")
    signed = F.when(F.substring(offset, 1, 1) == "+", minutes).otherwise(-minutes)
    shifted = F.when(offset == "", local).otherwise(
        F.timestamp_micros(F.unix_micros(local) - signed * 60_000_000)
    )
    parsed = F.when(text.rlike(UTC_ISO), text.try_cast("timestamp")).when(text.rlike(LENIENT_ISO), shifted)
    return F.when(~text.startswith("0000"), parsed)


def iso_text(ts: Column) -> Column:
    """ISO text in UTC; a fraction of six digits only when there is one."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def window_start(ts: Column, minutes: int = DEFAULT_WINDOW_MINUTES) -> Column:
    """Start of the ingest window. Windows restart every hour, so a width over 60 is the whole hour."""
    into_hour = F.floor(F.minute(ts) / F.lit(minutes)).cast("int") * minutes
    return F.date_trunc("hour", ts) + F.make_dt_interval(mins=into_hour)


def window_end(start: Column, minutes: int = DEFAULT_WINDOW_MINUTES) -> Column:
    """Last whole second of the window, used in its label."""
    return start + F.make_dt_interval(mins=F.lit(minutes), secs=F.lit(-1))


def window_label(start: Column, minutes: int = DEFAULT_WINDOW_MINUTES) -> Column:
    return F.concat_ws(
        "-", F.date_format(start, WINDOW_LABEL), F.date_format(window_end(start, minutes), WINDOW_LABEL)
    )
