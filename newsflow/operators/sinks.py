"""Windowed NDJSON output and the quarantine table, to any file system Spark can write.

Readers see complete output only: Spark's commit protocol takes the place of a marker file, and a
failed write fails the job instead of dropping rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import times
from .records import to_ndjson
from .windows import DEFAULT_MAX_OBJECT_BYTES, PARTITION_COLUMNS, assign_windows, rotate_files


# One layout for every writer, so that batch jobs and streams can share a root.
LEVELS = (*PARTITION_COLUMNS, "seq")


def write_windowed(
    records: DataFrame,
    uri: str,
    *,
    ingest_ts: str = "ingest_ts",
    minutes: int = times.DEFAULT_WINDOW_MINUTES,
    max_object_bytes: int | None = DEFAULT_MAX_OBJECT_BYTES,
    batch_id: int | str | None = None,
    slices: int | None = None,
) -> None:
    """Append records under ``uri/ingest_dt=../hour=../part=../seq=..``; ``uri`` decides the store.

    ``seq`` is the file number from the size rotation, which runs on ``slices`` partitions (by default
    ``spark.sql.shuffle.partitions``) however the rows spread over windows. ``max_object_bytes=None`` writes without
    rotation and without a shuffle, one file per task and window.

    With ``batch_id``, the name of a run or micro-batch, ``seq`` begins with it, and the write replaces what an
    earlier run of the same name left there. Without it rows are appended.
    """
    order = (ingest_ts, "news_id", "pos")
    # Only the line and what orders it go on: the rotation stores and shuffles its rows.
    placed = assign_windows(to_ndjson(records), ingest_ts, minutes).select(*PARTITION_COLUMNS, *order, "bytes", "line")
    mode, named = "append", ""
    if batch_id is not None:
        mode, named = "overwrite", f"batch-{batch_id}-"
    if max_object_bytes:
        rotated = rotate_files(placed, max_object_bytes, order, slices)
        placed = rotated.withColumn("seq", F.concat(F.lit(named), F.format_string("%06d", "file_seq")))
    else:
        placed = placed.withColumn("seq", F.lit(f"{named}000000"))
    lines = placed.sortWithinPartitions(*LEVELS, *order).select(*LEVELS, "line")
    writer = lines.write.mode(mode).option("lineSep", "\n").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LEVELS).text(uri)


def read_records(spark: SparkSession, uri: str) -> DataFrame:
    """Read written records back, with the partition keys as text columns."""
    keys = ", ".join(f"{name} STRING" for name in LEVELS)
    return spark.read.schema(f"{_ddl()}, {keys}").option("lineSep", "\n").json(uri)


def _ddl() -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.RECORD.fields)


def write_quarantine(rejects: DataFrame, uri: str, batch_id: int | str | None = None) -> None:
    """Append rejected messages as Parquet under ``reason=../batch=..``; a replayed batch is replaced."""
    batch = "none" if batch_id is None else str(batch_id)
    writer = rejects.withColumn("batch", F.lit(batch)).write.option("partitionOverwriteMode", "dynamic")
    writer.mode("append" if batch_id is None else "overwrite").partitionBy("reason", "batch").parquet(uri)
