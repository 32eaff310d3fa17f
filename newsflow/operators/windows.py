"""Ingest windows and size rotation of output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .rotation import greedy_files

# --- fixed values -----------------------------------------------------------------------------
DEFAULT_MAX_OBJECT_BYTES = 512_000_000
# ----------------------------------------------------------------------------------------------

PARTITION_COLUMNS = ("ingest_dt", "hour", "part")


def assign_windows(
    records: DataFrame, ingest_ts: str = "ingest_ts", minutes: int = times.DEFAULT_WINDOW_MINUTES
) -> DataFrame:
    """Add the partition keys ``ingest_dt``, ``hour`` and ``part`` (``start-end``) of the ingest time.

    A pure function of the time: half-open windows that restart every hour, in UTC.
    """
    start = times.window_start(F.col(ingest_ts), minutes)
    return records.withColumns(
        {
            "ingest_dt": F.date_format(start, "yyyy-MM-dd"),
            "hour": F.date_format(start, "HH"),
            "part": times.window_label(start, minutes),
        }
    )


def rotate_files(
    windowed: DataFrame,
    max_object_bytes: int = DEFAULT_MAX_OBJECT_BYTES,
    order: tuple[str, ...] = ("ingest_ts", "news_id", "pos"),
    slices: int | None = None,
    opened: DataFrame | None = None,
) -> DataFrame:
    """Add ``file_seq``: which file of its window a row belongs to, counting from 0.

    A file is closed by the first row that finds ``max_object_bytes`` in it, so it ends beyond the limit by less than one
    row. ``opened`` (part, file_seq, bytes) continues files of earlier runs.
    """
    return greedy_files(windowed, "part", order, "bytes", max_object_bytes, slices=slices, opened=opened)
