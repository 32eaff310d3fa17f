"""Typed values out of semi-structured (VARIANT) fields with lax, loss-free coercion.

Every ``lax_*`` function returns NULL both for an absent field and for a value it rejects; the kind that
was sent tells the two apart.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip
from .times import MAX_EPOCH_MILLIS, MIN_EPOCH_MILLIS, lenient_timestamp

# --- fixed values -----------------------------------------------------------------------------
INTEGER_TEXT = r"^[+-]?[0-9]++(_[0-9]++)*+(\.0++)?\z"
NUMBER_TEXT = r"^[+-]?([0-9]++(\.[0-9]*+)?|\.[0-9]++)\z"
# Epoch numbers beyond this magnitude count milliseconds, up to it seconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000
# Characters of one string that the JVM's JSON parser takes at most.
PARSER_LIMIT = 20_000_000
# ----------------------------------------------------------------------------------------------

# Follows the message inside a wrapper array. Its presence as second and last element proves that
# the raw text was one complete JSON value with nothing behind it.
_END_MARK = "newsflow:end-of-message"
_SURROGATE_PAIR = r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_SURROGATE = r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}"


def parse_json(raw: Column) -> Column:
    """The single JSON value ``raw`` holds as VARIANT; NULL when it is not exactly one valid value."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(f',"{_END_MARK}"]')))
    complete = (F.try_variant_get(wrapped, "$[1]", "string") == _END_MARK) & ~_has_lone_surrogate(raw)
    return F.when(complete, F.try_variant_get(wrapped, "$[0]", "variant"))


def beyond_parser(raw: Column) -> Column:
    """True if ``raw`` is long enough to hold a string that the JVM's JSON parser refuses."""
    return F.octet_length(raw) > PARSER_LIMIT


def _has_lone_surrogate(raw: Column) -> Column:
    escaped = F.contains(raw, F.lit("\\ud")) | F.contains(raw, F.lit("\\uD"))
    plain = F.regexp_replace(raw, r"\\\\", "")
    return F.when(escaped, F.regexp_replace(plain, _SURROGATE_PAIR, "").rlike(_SURROGATE)).otherwise(False)


class Sent(NamedTuple):
    """What was sent for a field: type name and text of its VARIANT. Both are NULL if it is absent.

    Keep the two as columns of their own. Spelled out inside every reading they make the generated code
    too large for the JVM to compile.
    """

    kind: Column
    text: Column


def sent(value: Column) -> Sent:
    return Sent(kind(value), F.try_variant_get(value, "$", "string"))


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """Type name of a VARIANT: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(value)


def is_string(value: Column) -> Column:
    return kind(value) == "STRING"


def is_object(value: Column) -> Column:
    return kind(value).startswith("OBJECT")


def is_present(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _is_number(type_name: Column) -> Column:
    return type_name.isin("BIGINT", "DOUBLE") | type_name.startswith("DECIMAL")


def lax_string(item: Sent) -> Column:
    return F.when(item.kind == "STRING", item.text)


def lax_bigint(item: Sent) -> Column:
    """Integers, integral floats, booleans and integer text; 64-bit range."""
    digits = strip(item.text)
    digits = F.when(digits.rlike(INTEGER_TEXT), F.regexp_replace(digits, r"_|\.0+$", ""))
    number = item.text.try_cast("double")
    return (
        F.when(item.kind == "BIGINT", item.text.try_cast("bigint"))
        .when(item.kind == "STRING", digits.try_cast("bigint"))
        .when(item.kind == "BOOLEAN", F.when(item.text == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
        .when(_is_number(item.kind), F.when(number == F.floor(number), number.try_cast("bigint")))
    )


def epoch_number(item: Sent) -> Column:
    """The number, or number in text form, that may stand for a time."""
    numeric = _is_number(item.kind) | ((item.kind == "STRING") & item.text.rlike(NUMBER_TEXT))
    return F.when(numeric, item.text.try_cast("decimal(30,9)"))


def lax_timestamp(item: Sent, number: Column) -> Column:
    """ISO text (``T``, ``t``, space or underscore; date only; any offset) and epoch seconds or ms.

    ``number`` is the column with ``epoch_number`` of the same field.
    """
    per_unit = F.when(F.abs(number) <= EPOCH_SECONDS_LIMIT, 1_000_000).when(
        number.between(MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS), 1_000
    )
    from_number = F.timestamp_micros(F.round(number * per_unit).cast("bigint"))
    return F.when(number.isNotNull(), from_number).when(item.kind == "STRING", lenient_timestamp(item.text))


def coerce_list(value: Column) -> Column:
    """A list as it is, nothing or null as an empty list, any other value as a list of one."""
    empty = F.array().cast("array<variant>")
    return F.when(~F.coalesce(is_present(value), F.lit(False)), empty).otherwise(
        F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))
    )


def lax_strings(value: Column) -> Column:
    """List of strings after ``coerce_list``; NULL if any element is not a string."""
    texts = F.transform(coerce_list(value), lambda e: lax_string(sent(e)))
    return F.when(~F.exists(texts, lambda t: t.isNull()), texts)
