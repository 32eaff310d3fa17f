"""Text sources: landed messages, NDJSON archives, service logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import json_values as jv
from ..functions.text import is_blank, strip
from ..session import materialize

# The archives, and what this package writes.
ARCHIVE_GLOB = "*.{ndjson,txt}"
# Splits of all files up to this number are broadcast; beyond, the join is shuffled.
BROADCAST_SPLITS = 500_000


def read_messages(spark: SparkSession, uri: str) -> DataFrame:
    """Raw messages, one JSON text per line, as column ``raw``."""
    return spark.read.option("lineSep", "\n").text(uri).withColumnRenamed("value", "raw")


def stream_messages(spark: SparkSession, uri: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form of ``read_messages`` over a landing folder."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(uri).withColumnRenamed("value", "raw")


def read_archive(spark: SparkSession, uri: str, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """All lines of the archive files below ``uri``: ``path``, ``block``, ``line_no``, ``line``.

    ``block`` is where the file split starts and ``line_no`` grows within it, so
    ``(path, block, line_no)`` is the order of the lines. Files are split, never read whole.
    """
    lines = (
        spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(uri)
    )
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_number``: where a line stands in its file, counted from 1 with blank lines, to what ``read_archive`` gives.

    Two passes over the files, none of which takes a file as a whole: the splits' numbers of lines are summed up first
    (one row per split), then each line adds its place in its split. Keep all lines up to here.
    """
    splits = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(splits.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "line-starts")
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    number = F.col("start") + F.col("line_no") - F.col("first") + 1
    return lines.join(starts, ["path", "block"]).select(*lines.columns, number.alias("line_number"))


def list_archive(spark: SparkSession, uri: str, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """Paths of the archive files in order. Lists the files without reading their content."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(uri)
    )
    return files.select(F.col("_metadata.file_path").alias("path")).orderBy("path")


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lenient NDJSON: drop blank lines, add ``value`` (VARIANT, NULL when the line is not JSON)."""
    text = strip(line)
    return lines.where(~is_blank(line)).withColumn("value", jv.parse_json(text))


def bad_lines(parsed: DataFrame) -> DataFrame:
    """Lines that are not JSON, with where they stand: all columns of the lines, see ``number_lines``."""
    return parsed.where(F.col("value").isNull()).drop("value")


def read_service_log(spark: SparkSession, uri: str) -> DataFrame:
    """Service log, one JSON object per line."""
    return spark.read.schema(schema.SERVICE_LOG).json(uri)
