"""Whole jobs built from the operators; the stream runs the same functions on its micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHERE_SUMMARY_FAILED, fallback_limit
from ..functions.times import DEFAULT_WINDOW_MINUTES
from ..operators import enrich, ingest, objects, records, sinks
from ..session import materialize, run_folder


def _ready(articles: DataFrame, factory: Callable[[], enrich.Invoke] | None, fallback_chars: int | str | None) -> DataFrame:
    """Articles with cleaned texts and the content that they have without a summary."""
    cleaned = records.clean_articles(articles)
    return records.choose_content(cleaned, fallback_chars=fallback_limit(fallback_chars, factory is not None))


def _summarized(
    ready: DataFrame, factory: Callable[[], enrich.Invoke], policy: enrich.CallPolicy | None, keep: tuple[str, ...], options: dict
) -> DataFrame:
    """Only what records need goes on; the summary, where there is one, takes the place of the content."""
    summarized = enrich.summarize_articles(ready, factory, policy, columns=(*records.SOURCE_COLUMNS, *keep), **options)
    return summarized.withColumn("content", F.coalesce(F.nullif("summary", F.lit("")), "content"))


def route_messages(
    parsed: DataFrame,
    factory: Callable[[], enrich.Invoke] | None = None,
    policy: enrich.CallPolicy | None = None,
    keep: tuple[str, ...] = ("ingest_ts",),
    *,
    fallback_chars: int | str | None = WHERE_SUMMARY_FAILED,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Records (as ``articles_to_records``) and rejects (``raw``, ``reason``, ``errors``, ``keep``) of one parse.

    Each message is parsed once, in one job without a shuffle, which stores where it goes: of an accepted one what
    records and calls need (the prompt, but no HTML), of a rejected one what the quarantine keeps. Both results read
    their own columns of that table, so a task that is lost during the calls parses nothing again. ``keep`` goes along
    with both.
    """
    accepted = F.col("reason").isNull()
    # Rejected messages have nothing to clean.
    ready = _ready(parsed.withColumns({c: F.when(accepted, F.col(c)) for c in ("body", "teaser")}), factory, fallback_chars)
    called = []
    if factory is not None:
        text = options.pop("text", None)
        prompt = enrich.default_text(policy or enrich.CallPolicy()) if text is None else text
        called = [F.when(accepted, prompt).alias("_prompt"), "teaser_clean"]
        options["text"] = F.col("_prompt")
    raw = F.when(~accepted, F.col("raw")).alias("raw")
    stored = materialize(ready.select(*records.SOURCE_COLUMNS, *keep, *called, raw, "reason", "errors"), "routed")
    rejects = stored.where("reason IS NOT NULL").select("raw", "reason", "errors", *keep)
    chosen = stored.where("reason IS NULL").drop("raw", "reason", "errors")
    if factory is not None:
        # Read more than once by the rotation, which must not call again.
        chosen = materialize(_summarized(chosen, factory, policy, keep, options).select(*records.SOURCE_COLUMNS, *keep), "article-content")
    return records.explode_tickers(chosen, *keep), rejects


def articles_to_records(
    articles: DataFrame,
    factory: Callable[[], enrich.Invoke] | None,
    policy: enrich.CallPolicy | None = None,
    keep: tuple[str, ...] = (),
    *,
    store_content: bool = False,
    fallback_chars: int | str | None = WHERE_SUMMARY_FAILED,
    **options,
) -> DataFrame:
    """Accepted articles to output rows. Without a service every article gets its fallback content.

    ``fallback_chars`` cuts that content, None keeps whole texts; by default only content that stands for a failed summary
    is cut. With a service it is worked out first, so that the HTML and the cleaned texts are not carried to the calls.

    Every step up to the last works once per article; the fan-out to tickers comes last.
    ``store_content`` writes the articles with their content (but without their bodies) before the
    fan-out. Use it when the rows are read more than once, or each reading would call the service;
    range partitioning counts as two readings, because it samples its input first.
    """
    ready = _ready(articles, factory, fallback_chars)
    chosen = ready if factory is None else _summarized(ready, factory, policy, keep, options)
    if store_content:
        chosen = materialize(chosen.select(*records.SOURCE_COLUMNS, *keep), "article-content")
    return records.explode_tickers(chosen, *keep)


def run_batch(
    messages: DataFrame,
    output: str,
    rejects: str | None = None,
    factory: Callable[[], enrich.Invoke] | None = None,
    policy: enrich.CallPolicy | None = None,
    *,
    batch_id: int | str | None = None,
    minutes: int = DEFAULT_WINDOW_MINUTES,
    max_object_bytes: int | None = sinks.DEFAULT_MAX_OBJECT_BYTES,
    slices: int | None = None,
    writer: str | None = None,
    **options,
) -> None:
    """Raw messages (``raw``, optional ``ingest_ts``) to windowed NDJSON and a quarantine table.

    With rotation or ``writer`` every message is parsed once for both outputs (see ``route_messages``), and the service is
    called once per article. Without either (``max_object_bytes=None``) nothing is stored in between: records and
    rejects are a map-only write each, and only the parse runs for both. ``batch_id`` names the run: a run of the
    same name replaces what the last one wrote, rejects included. Without it rows are appended. Stored intermediate
    tables are removed at the end. ``writer`` writes files under names of their own instead (see ``objects``), and a
    numbered run goes on with the files that the last one left open. With ``writer`` and without ``rejects`` the rejects are
    files below ``output`` (``objects.read_rejects``), which become visible in one commit with the records.
    """
    if rejects is None and writer is None:
        raise ValueError("rejects need a place of their own unless a writer commits them with the records")
    if "ingest_ts" not in messages.columns:
        messages = messages.withColumn("ingest_ts", F.current_timestamp())
    parsed = ingest.parse_messages(messages)
    with run_folder(messages.sparkSession):
        if not (max_object_bytes or writer):
            sinks.write_quarantine(ingest.quarantine(parsed), rejects, batch_id)
            rows = articles_to_records(ingest.accepted(parsed), factory, policy, ("ingest_ts",), **options)
        else:
            rows, left_out = route_messages(parsed, factory, policy, **options)
            if rejects is not None:
                sinks.write_quarantine(left_out.drop("ingest_ts"), rejects, batch_id)
        if writer:
            limit, carry = max_object_bytes or sinks.DEFAULT_MAX_OBJECT_BYTES, isinstance(batch_id, int)
            together = left_out if rejects is None else None
            objects.write_objects(rows, output, writer=writer, minutes=minutes, max_object_bytes=limit, run=batch_id, carry=carry, slices=slices, rejects=together)
            return
        sinks.write_windowed(
            rows, output, minutes=minutes, max_object_bytes=max_object_bytes, batch_id=batch_id, slices=slices
        )
