"""Raw JSON messages to validated articles, with every reject kept and labelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import json_values as jv
from ..functions.tickers import tickers_of

# Output column: field of the message, and what it holds.
_FIELDS = {
    "api_version": ("api_version", "text"),
    "kind": ("kind", "text"),
    "id": ("data.id", "integer"),
    "timestamp": ("data.timestamp", "time"),
    "action": ("data.action", "text"),
    "content_id": ("data.content.id", "integer"),
    "revision_id": ("data.content.revision_id", "integer"),
    "type": ("data.content.type", "text"),
    "title": ("data.content.title", "text"),
    "body": ("data.content.body", "text"),
    "teaser": ("data.content.teaser", "text"),
    "url": ("data.content.url", "text"),
    "authors": ("data.content.authors", "texts"),
    "channels": ("data.content.channels", "texts"),
    "securities": ("data.content.securities", "list"),
    "created_at": ("data.content.created_at", "time"),
    "updated_at": ("data.content.updated_at", "time"),
}
_REQUIRED = ("id", "timestamp")


def _struct_of(prefix: str) -> str:
    """DDL of the message below ``prefix``: nested objects as structs, all leaves as VARIANT."""
    below = [path[len(prefix) :] for path, _ in _FIELDS.values() if path.startswith(prefix)]
    names = dict.fromkeys(path.split(".")[0] for path in below)
    nested = {path.split(".")[0] for path in below if "." in path}
    parts = [f"`{n}`: {_struct_of(f'{prefix}{n}.') if n in nested else 'variant'}" for n in names]
    return f"struct<{', '.join(parts)}>"


_SHAPE = _struct_of("")


def seal(df: DataFrame, keep: list[str], columns: list[Column]) -> DataFrame:
    """Select ``keep`` and ``columns`` so that filters on ``columns`` stay above this point.

    Spark copies the definition of a plain column into every filter on it that it moves down, also into
    the ones it infers for an explode. With columns that stand for a parsed message this parses each
    message again, several times over. It does not move filters past a generator, so the columns
    pass through one: a list of one struct.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def read_fields(df: DataFrame, values: dict[str, Column], kinds: dict[str, str], paths: dict[str, str] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """Add one typed column per VARIANT of ``values``, and ``wrong_type``: some value was rejected.

    ``kinds`` says what each holds: text, integer, time, texts (list of text) or list (of anything). With ``paths`` the
    column ``errors`` lists the rejected fields, and those of ``required`` that are missing.
    """
    scalars = [name for name, kind in kinds.items() if kind not in ("texts", "list")]
    items = {name: jv.Sent(F.col(f"_kind_{name}"), F.col(f"_text_{name}")) for name in scalars}
    sent = {name: jv.sent(values[name]) for name in scalars}
    split = df.select(
        "*",
        *[sent[n].kind.alias(f"_kind_{n}") for n in scalars],
        *[sent[n].text.alias(f"_text_{n}") for n in scalars],
        *[jv.kind(values[n]).alias(f"_kind_{n}") for n, kind in kinds.items() if kind == "texts" and paths],
        *[jv.lax_strings(values[n]).alias(n) for n, kind in kinds.items() if kind == "texts"],
        *[jv.coerce_list(values[n]).alias(n) for n, kind in kinds.items() if kind == "list"],
    )
    times = [name for name, kind in kinds.items() if kind == "time"]
    numbered = split.select("*", *[jv.epoch_number(items[n]).alias(f"_number_{n}") for n in times])
    readers = {"text": jv.lax_string, "integer": jv.lax_bigint}
    typed = numbered.select(
        "*",
        *[readers[kinds[n]](items[n]).alias(n) for n in scalars if n not in times],
        *[jv.lax_timestamp(items[n], F.col(f"_number_{n}")).alias(n) for n in times],
    )
    # Sent, but not of the wanted type; lists have no NULL result otherwise.
    wrong = {n: f"(`_kind_{n}` != 'VOID' AND `{n}` IS NULL)" for n in scalars}
    wrong |= {n: f"`{n}` IS NULL" for n, kind in kinds.items() if kind == "texts"}
    wrong_type = F.coalesce(F.expr(" OR ".join(wrong.values())), F.lit(False)).alias("wrong_type")
    if not paths:
        return typed.select(*df.columns, *kinds, wrong_type)
    found = [F.when(F.expr(f"`{n}` IS NULL" if n in required else text), _error(paths[n], F.col(f"_kind_{n}"), kinds[n])) for n, text in wrong.items()]
    return typed.select(*df.columns, *kinds, wrong_type, F.array_compact(F.array(*found)).alias("errors"))


def _error(path: str, kind: Column, wanted: str) -> Column:
    """What was sent for a field, by its kind alone (STRING, not its length), and what was wanted."""
    sent = F.coalesce(F.nullif(F.regexp_extract(kind, "^[A-Z]+", 0), F.lit("VOID")), F.lit("missing"))
    return F.struct(F.lit(path).alias("field"), sent.alias("sent"), F.lit(wanted).alias("wanted"))


def parse_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the typed message columns, ``tickers``, ``reason`` (NULL for an accepted message) and ``errors``.

    Keeps all rows and all columns of ``df``. A present optional field of the wrong type rejects the
    whole message, as does a missing required one. Values are read only once the JSON is valid. ``errors`` lists, for a message
    that failed validation, every field at fault: its path, the kind that was sent, and the kind that was wanted.
    """
    kept = [F.col(c) for c in df.columns]
    decoded = df.select(*kept, jv.parse_json(F.col(raw)).alias("_value"))
    # One pass over the value takes it apart; fields keep their own JSON type. NULL if it is no message.
    shaped = decoded.select(
        *kept,
        F.when(F.col("_value").isNull(), F.when(jv.beyond_parser(F.col(raw)), schema.TOO_LARGE).otherwise(schema.DECODE_FAILED)).alias("_undecoded"),
        F.try_variant_get("_value", "$", _SHAPE).alias("_msg"),
        jv.kind(F.col("_value")).alias("_whole"),
    )
    values = {name: F.col(f"_msg.{path}") for name, (path, _) in _FIELDS.items()}
    kinds, paths = ({name: field[k] for name, field in _FIELDS.items()} for k in (1, 0))
    typed = read_fields(shaped, values, kinds, paths, _REQUIRED)
    invalid = F.col("_msg.data.content").isNull() | F.col("wrong_type")
    for name in _REQUIRED:
        invalid = invalid | F.col(name).isNull()
    reason = (
        F.when(F.col("_undecoded").isNotNull(), F.col("_undecoded"))
        .when(invalid, F.lit(schema.VALIDATION_FAILED))
        .when(F.size("tickers") == 0, F.lit(schema.NO_SECURITIES))
    )
    no_content = F.when(F.col("_msg.data.content").isNull(), _error("data.content", F.lit("VOID"), "object"))
    listed = F.when(F.col("_msg").isNull(), F.array(_error("$", F.col("_whole"), "object"))).otherwise(F.array_compact(F.concat("errors", F.array(no_content))))
    found = typed.select("*", tickers_of(F.col("securities")).alias("tickers"), F.when(F.col("_undecoded").isNull() & invalid, listed).alias("_listed"))
    return seal(found, df.columns, [*[F.col(n) for n in _FIELDS], F.col("tickers"), reason.alias("reason"), F.col("_listed").alias("errors")])


def accepted(parsed: DataFrame, raw: str = "raw") -> DataFrame:
    """Articles that go on: valid, with at least one ticker. Apply before any cleaning or summary."""
    return parsed.where(F.col("reason").isNull()).drop(raw, "reason", "errors")


def quarantine(parsed: DataFrame, raw: str = "raw") -> DataFrame:
    """Messages that were left out, with the reason and the fields at fault; nothing is lost silently."""
    return parsed.where(F.col("reason").isNotNull()).select(F.col(raw).alias("raw"), "reason", "errors")
