"""Line dedup: repeated lines go everywhere but in the first document that holds them.

Lines are exploded with their position, a normalised key of each is hashed, distinct documents are counted per hash,
and the lines of a hash that too many documents share are dropped outside the smallest doc_id. Only hashes, ids and
positions are shuffled for that; each text is split twice and moves once, to meet its own flags.

Defined cases: a null or empty text is one empty line. A document without doc_id keeps all its lines and is not
counted. Rows that repeat a doc_id count as one document and each returns its own row. Columns of ``docs`` called n_lines or
n_dropped are replaced, all others stay. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import ASCII_SPACE, ascii_lower, broadcast_up_to, materialize

BROADCAST_ROWS = 300_000


def line_flags(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(id, version, flags): for each document text, one boolean per line, true where the line goes. Jobs run while this is called."""
    lines = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    key = F.btrim(ascii_lower(F.col("line")), F.lit(ASCII_SPACE))
    # Stored, so that each text is split and hashed once.
    hashed = materialize(lines.select("id", "version", "pos", F.when(F.char_length(key) >= min_chars, F.md5(key)).alias("hash")), "lines")
    shared = (
        hashed.filter("hash IS NOT NULL AND id IS NOT NULL")
        .groupBy("hash", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash")
        .agg(F.count("*").alias("n_docs"), F.min("id").alias("owner"))
        .filter(F.col("n_docs") >= min_docs)
        .select("hash", "owner")
    )
    # Stored as well: a join of two tables is one whose hot hashes Spark can split, where it is not broadcast.
    known = broadcast_up_to(materialize(shared, "shared-lines"), BROADCAST_ROWS)
    judged = hashed.join(known, "hash", "left").select(
        "id", "version", "pos", F.coalesce(F.col("id") > F.col("owner"), F.lit(False)).alias("drop")
    )
    # collect_set: rows that repeat a document bring the same (position, flag) pairs again.
    flags = F.transform(F.sort_array(F.collect_set(F.struct("pos", "drop"))), lambda x: x["drop"])
    return judged.groupBy("id", "version").agg(flags.alias("flags"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the text rejoined from the lines that stay, ``n_lines`` before and ``n_dropped``."""
    flags = line_flags(docs, min_chars, min_docs).toDF("__id", "__version", "__flags")
    text = F.coalesce(F.col("text"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__version"))
    joined = docs.join(flags, same, "left").withColumn(
        "__lines", F.arrays_zip(F.split(text, "\n", -1).alias("line"), F.col("__flags").alias("drop"))
    )
    kept = F.transform(F.filter("__lines", lambda x: ~x["drop"]), lambda x: x["line"])
    return joined.select(
        *[F.array_join(kept, "\n").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.filter("__flags", lambda x: x)).cast("long").alias("n_dropped"),
    )
