"""Rewrite of stored NDJSON: ISO text in the top-level ``timestamp`` becomes epoch milliseconds.

Only the bytes of that value change. A line that is not JSON, has no such value, or whose value cannot
be read stays as it is, so the rewrite can be run again. Output goes to a new root; Spark must not
overwrite what it reads.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from json.decoder import scanstring
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import json_values as jv
from ..functions import text as tx
from ..functions import times
from ..session import materialize
from ..sources.files import ARCHIVE_GLOB, list_archive, parse_lines, read_archive
from . import enrich
from .ingest import read_fields, seal
from .objects import PART_MARK, write_keyed
from .records import choose_content, clean_articles, explode_tickers

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_KEY = r'(?<!\\)"timestamp"\s*+:'
_KEY_WITH_TEXT = rf'(?<key>{_KEY}\s*+)"(?<iso>[^"\\]*+)"'
# What locates a line: the columns of ``read_archive``, or a key of its own.
_LINE_COLUMNS = ("path", "block", "line_no", "key", "line")
_MANIFEST = "path string, size long, modified timestamp, key string, state string"
FILES_PER_JOB = 10_000
# ISO spellings that Spark and Python's datetime read alike.
_PLAIN_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ](?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]{1,6})?"
    r"(?:Z|[+-](?:0[0-9]|1[0-7]):[0-5][0-9])?\z"
)


def iso_to_millis(text: str) -> int:
    """Epoch milliseconds of any ISO 8601 text Python reads; no offset means UTC."""
    moment = datetime.fromisoformat(text)
    since = moment.replace(tzinfo=moment.tzinfo or timezone.utc) - _EPOCH
    return int(since.total_seconds() * 1000)


def _replace_top_level(line: str) -> str:
    """Replace the value of the last top-level ``timestamp`` key if it is readable text."""
    decoder = json.JSONDecoder()
    space = json.decoder.WHITESPACE.match
    span = None
    try:
        at = space(line, line.index("{") + 1).end()
        while line[at] == '"':
            key, at = scanstring(line, at + 1)
            start = space(line, space(line, at).end() + 1).end()
            value, at = decoder.raw_decode(line, start)
            if key == "timestamp":
                span = (start, at, value)
            at = space(line, space(line, at).end() + 1).end()
            if at >= len(line):
                break
        if span is None or not isinstance(span[2], str):
            return line
        return f"{line[: span[0]]}{iso_to_millis(span[2])}{line[span[1] :]}"
    except (ValueError, IndexError, OverflowError):
        return line


@F.pandas_udf(T.StringType())
def _rewrite_hard_lines(lines: pd.Series) -> pd.Series:
    return lines.map(_replace_top_level, na_action="ignore")


def rewrite_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Rewrite the column ``line``; all other columns stay.

    Lines without a text value after the key pass untouched and unparsed. The frequent form (the key
    once, plain ISO text) is replaced in the JVM. Other valid objects - the key also nested or
    repeated, escapes, rare ISO spellings, values too long for the JVM's parser - go to Python, which gets NULL for all other rows.
    """
    text = F.col(line)
    # The key can also be spelled with escapes.
    candidate = text.rlike(rf'{_KEY}\s*+"') | F.contains(text, F.lit("\\u"))
    sent = F.when(candidate, jv.field(jv.parse_json(text), "timestamp"))
    once = F.regexp_count(text, F.lit(_KEY)) == 1
    iso = F.when(F.coalesce(jv.is_string(F.col("_sent")), F.lit(False)), F.regexp_extract(text, _KEY_WITH_TEXT, 2))
    millis = times.epoch_millis(_utc(F.col("_iso")).try_cast("timestamp"))
    plain = F.regexp_replace(text, F.lit(_KEY_WITH_TEXT), F.concat(F.lit("${key}"), F.col("_millis").cast("string")))
    unread = F.col("_sent").isNull() & candidate & jv.beyond_parser(text)
    is_hard = (F.col("_iso").isNotNull() & F.col("_millis").isNull()) | unread
    # Every step uses the one before more than once, which keeps the optimizer from merging them.
    steps = (
        lines.withColumn("_sent", sent)
        .withColumn("_iso", iso)
        .withColumn("_millis", F.when(once & F.col("_iso").rlike(_PLAIN_ISO), millis))
        .withColumn("_hard", _rewrite_hard_lines(F.when(is_hard, text)))
    )
    result = F.when(F.col("_millis").isNotNull(), plain).otherwise(F.coalesce("_hard", text))
    return steps.withColumn(line, result).select(*lines.columns)


def _utc(iso: Column) -> Column:
    return F.when(iso.rlike(r"(?:Z|[+-][0-9]{2}:[0-9]{2})$"), iso).otherwise(F.concat(iso, F.lit("Z")))


def _without_outer_blanks(lines: DataFrame) -> DataFrame:
    """Drop blank lines before the first and after the last line with content of each file.

    The lines meet their file's bounds by split, so that one large file is not one task. A file of blank lines only
    stays as it is.
    """
    at = F.struct("block", "line_no")
    blocks = lines.groupBy("path", "block").agg(
        F.min(F.when(~tx.is_blank("line"), at)).alias("_first"), F.max(F.when(~tx.is_blank("line"), at)).alias("_last")
    )
    files = blocks.groupBy("path").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    bounds = blocks.select("path", "block").join(files, "path")
    inside = F.col("_first").isNull() | at.between(F.col("_first"), F.col("_last"))
    return lines.join(bounds, ["path", "block"]).where(inside).drop("_first", "_last")


def rewrite_archive(
    spark: SparkSession, source: str, target: str, glob: str = ARCHIVE_GLOB, trim_files: bool = False
) -> None:
    """Rewrite all files below ``source`` into ``target/file=<key>``, one folder per file; see ``file_keys``.

    Map-only: no shuffle. A split becomes a part file. Spark numbers the splits of a file by their offset, so the part
    files of a folder, sorted by name, hold the lines in order. ``trim_files`` also drops blank lines at both
    ends of a file, which costs a second pass and a join; parts are then sorted by offset. The caller swaps the roots
    when the job has succeeded.
    """
    lines = read_archive(spark, source, glob)
    if trim_files:
        placed = _without_outer_blanks(lines).repartitionByRange("path", "block")
    else:
        placed = lines
    out = rewrite_lines(placed).select(_file_key(F.col("path")).alias("file"), "block", "line_no", "line")
    ordered = out.sortWithinPartitions("file", "block", "line_no").drop("block", "line_no")
    ordered.write.option("lineSep", "\n").partitionBy("file").text(target)


def _file_key(path: Column) -> Column:
    """Short name for a path of any length."""
    return F.md5(path.cast("binary"))


def file_keys(spark: SparkSession, source: str, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """(file, path): the folder that ``rewrite_archive`` gives each file. Lists the files, reads none."""
    return list_archive(spark, source, glob).select(_file_key(F.col("path")).alias("file"), "path")


def _listing(spark: SparkSession, source: str, glob: str) -> DataFrame:
    """(path, size, modified, key): the archive files and their paths below ``source``. Reads no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(source)
    found = files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return found.withColumn("key", _relative(spark, F.col("path"), source))


def _relative(spark: SparkSession, path: Column, source: str) -> Column:
    """The part of a file's URI below ``source``, as a plain path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(source)
    base = re.sub("^file:/+", "file:/", root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().toString())
    below = F.substring(F.regexp_replace(path, "^file:/+", "file:/"), len(base) + 2, 1 << 20)
    return F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))


def manifest(spark: SparkSession, target: str) -> DataFrame | None:
    """The files that ``rewrite_changed`` has dealt with, of the last run that finished: path, size, modified, key, state."""
    last = _last_version(spark, target)
    return spark.read.schema(_MANIFEST).parquet(f"{target}/_manifest/v={last}") if last else None


def _last_version(spark: SparkSession, target: str) -> int:
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_manifest")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return 0
    versions = [s.getPath() for s in system.listStatus(root)]
    done = [int(p.getName()[2:]) for p in versions if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(done, default=0)


def rewrite_changed(spark: SparkSession, source: str, target: str, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """Rewrite the files below ``source`` that are new or changed since the last run, each under its own path below ``target``.

    Returns the manifest of this run: ``state`` is ``rewritten``, ``unchanged``, or ``gone`` for a file that the source no longer has (its
    rewritten form stays). Map-only; a file of several splits becomes one file per split, ``<name>.at-<offset>.<ending>``, which
    sort in order. Rewritten files appear when all of a job's files are complete, and the manifest is committed after them: if
    a run stops between, the next one rewrites the same files once more, with the same result.
    """
    listed = materialize(_listing(spark, source, glob), "archive-files")
    known = manifest(spark, target)
    known = materialize(known.filter("state <> 'gone'").drop("state"), "known-files") if known is not None else listed.limit(0)
    same = ["path", "size", "modified"]
    changed = materialize(listed.join(known, same, "left_anti").orderBy("path"), "changed-files")
    # Names only, and so many files at a time.
    for batch in _batches(changed.select("path").toLocalIterator(prefetchPartitions=True), FILES_PER_JOB):
        _rewrite_files(spark, batch, source, target)
    fresh = changed.select(*same, "key", F.lit("rewritten").alias("state"))
    kept = listed.join(known.select(*same), same, "left_semi").select(*same, "key", F.lit("unchanged").alias("state"))
    gone = known.join(listed.select("path"), "path", "left_anti").select(*same, "key", F.lit("gone").alias("state"))
    version = _last_version(spark, target) + 1
    fresh.union(kept).union(gone).write.mode("overwrite").parquet(f"{target}/_manifest/v={version}")
    return manifest(spark, target)


def _batches(rows: Iterable[Row], size: int) -> Iterator[list[str]]:
    batch = []
    for row in rows:
        batch.append(row.path)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def _rewrite_files(spark: SparkSession, paths: list[str], source: str, target: str) -> None:
    names = [unquote(p) for p in paths]
    lines = spark.read.option("lineSep", "\n").text(names).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("is_split"),
        F.col("value").alias("line"),
    )
    own = _relative(spark, F.col("path"), source)
    part = F.regexp_replace(own, r"\.([^./]*)$", F.concat(F.lit(PART_MARK), F.lpad(F.col("block").cast("string"), 15, "0"), F.lit(".$1")))
    key = F.when(F.col("is_split"), part).otherwise(own)
    write_keyed(rewrite_lines(lines).select(key.alias("key"), "line"), target)


def read_legacy(lines: DataFrame) -> DataFrame:
    """Legacy rows (one ticker, HTML ``body``) typed as articles; ``reason`` says why one is unusable, else NULL.

    ``decode-failed``, ``wrong-type``, or ``missing-`` with the name of the field: ticker, news_id or timestamp.
    """
    kinds = {
        "news_id": "integer",
        "timestamp": "time",
        "ticker": "text",
        "action": "text",
        "title": "text",
        "body": "text",
        "teaser": "text",
        "url": "text",
        "authors": "texts",
        "channels": "texts",
        "created_at": "time",
        "updated_at": "time",
    }
    typed = read_fields(parse_lines(lines), {n: jv.field(F.col("value"), n) for n in kinds}, kinds)
    ticker = tx.strip("ticker")
    reason = F.when(F.col("value").isNull(), schema.DECODE_FAILED).when(F.col("wrong_type"), schema.WRONG_TYPE)
    reason = reason.when(F.coalesce(ticker, F.lit("")) == "", "missing-ticker")
    for name in ("news_id", "timestamp"):
        reason = reason.when(F.col(name).isNull(), f"missing-{name}")
    columns = [F.col(n).alias("id" if n == "news_id" else n) for n in kinds if n != "ticker"]
    return seal(typed, lines.columns, [*columns, F.array(ticker).alias("tickers"), reason.alias("reason")])


def usable_legacy(legacy: DataFrame) -> DataFrame:
    """The rows of ``read_legacy`` that go on. Apply before any cleaning."""
    return legacy.where(F.col("reason").isNull()).drop("reason", "line")


def migration_failures(legacy: DataFrame) -> DataFrame:
    """The rows of ``read_legacy`` that were left out: where they stand (all columns of the lines) and why."""
    return legacy.where(F.col("reason").isNotNull()).select(*[c for c in legacy.columns if c in _LINE_COLUMNS], "reason")


def migrate(
    lines: DataFrame,
    factory=None,
    policy: enrich.CallPolicy | None = None,
    *,
    html: bool = False,
    fallback_chars: int | str | None = tx.WHERE_SUMMARY_FAILED,
    **options,
) -> DataFrame:
    """Usable legacy rows as articles with ``content`` and, with a service, the columns of its calls.

    ``html`` sends the raw HTML bodies to the service instead of the cleaned texts; a missing summary falls back to
    the cleaned text either way, cut to ``fallback_chars``; without a service bodies stay whole.
    """
    ready = choose_content(clean_articles(usable_legacy(read_legacy(lines))), fallback_chars=tx.fallback_limit(fallback_chars, factory is not None))
    if factory is None:
        return ready
    summarize = enrich.summarize_html if html else enrich.summarize_articles
    done = summarize(ready, factory, policy, **options)
    return done.withColumn("content", F.coalesce(F.nullif("summary", F.lit("")), "content"))


def backfill(lines: DataFrame, factory=None, policy: enrich.CallPolicy | None = None, **options) -> DataFrame:
    """Output records of the usable legacy rows, plus ``path``; see ``migrate``."""
    return explode_tickers(migrate(lines, factory, policy, **options), "path")
