"""Ticker symbols out of the mixed ``securities`` list, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import json_values as jv
from .text import strip


def symbol_of(security: Column) -> Column:
    """Symbol of one element: trimmed text, or an object's non-empty ``symbol`` text as it stands."""
    item = jv.sent(security)
    inner = jv.lax_string(jv.sent(jv.field(security, "symbol")))
    found = F.when(item.kind == "STRING", strip(item.text)).when(item.kind.startswith("OBJECT"), inner)
    return F.nullif(found, F.lit(""))


def tickers_of(securities: Column) -> Column:
    """All symbols in order, repeats kept."""
    return F.filter(F.transform(securities, symbol_of), lambda s: s.isNotNull())


def primary_ticker(tickers: Column) -> Column:
    """The first ticker: the subject named in the summary prompt."""
    return F.get(tickers, F.lit(0))
