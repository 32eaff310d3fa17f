"""Small helpers shared by the operators: table reads, sizes, broadcasts behind a check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import materialize

__all__ = ["ASCII_SPACE", "ascii_lower", "broadcast_up_to", "materialize", "read", "text_bytes"]

# ASCII white space: space and \x09 to \x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(text, _UPPER, _UPPER.lower())


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of a text column: one aggregate, used to size groups and buckets."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def broadcast_up_to(df: DataFrame, rows: int, entries: str | None = None) -> DataFrame:
    """Hint a broadcast if the (stored) table holds at most ``rows`` rows; beyond, Spark plans a shuffled join.

    ``entries`` names an array column whose entries count as rows, so that long arrays are not broadcast unseen.
    """
    weight = F.size(entries) + 1 if entries else F.lit(1)
    return F.broadcast(df) if (df.agg(F.sum(weight.cast("long"))).first()[0] or 0) <= rows else df
