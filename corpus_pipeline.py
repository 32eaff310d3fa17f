"""From raw documents to a training mixture: each stage reads what its predecessor kept.

Defined cases: rows without doc_id pass the filters by their text alone and are never taken as duplicates; rows that
repeat both doc_id and text are one document after the near-dedup stage. Texts that lose all lines stay as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.decontaminate import contaminated, contamination
from newsflow.llm.line_dedup import dedup_lines
from newsflow.llm.mixing import mix_to_targets
from newsflow.llm.near_dedup import near_duplicates
from newsflow.llm.quality_lm import classify
from newsflow.llm.queries import good_labels
from newsflow.llm.tables import broadcast_up_to, materialize, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BROADCAST_ROWS = 500_000
# Shares of the languages in the mixture. What tells good from low or toxic text is gone by then, languages are what is left to mix.
TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
NEAR = 80  # hundredths of the shingles that near copies share at least; the op7 query has a limit of its own, 85


def _version() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the (id, version) pairs of ``gone``."""
    stored = broadcast_up_to(materialize(gone.select("id", "version").distinct(), "gone"), BROADCAST_ROWS)
    return docs.join(stored, docs["doc_id"].eqNullSafe(stored["id"]) & (_version() == stored["version"]), "left_anti")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = classify(docs, good_labels(spark, sf_dir))
    return _without(docs, judged.filter("NOT kept").select(F.col("doc_id").alias("id"), "version"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = dedup_lines(docs).select(docs.columns)
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = materialize(near_duplicates(docs, part=NEAR, whole=100).select(F.col("doc_id").alias("id"), "version", "kept"), "judged")
    kept = _without(docs, judged.filter("NOT kept"))
    again = materialize(judged.filter("kept AND id IS NOT NULL").groupBy("id", "version").count().filter("count > 1").select("id", "version"), "again")
    if again.isEmpty():
        return kept
    # Only rows that repeat are gathered, and their copies are merged before they travel.
    mine = (kept["doc_id"] == again["id"]) & (_version() == again["version"])
    repeated = kept.join(broadcast_up_to(again, BROADCAST_ROWS), mine, "left_semi")
    one = repeated.groupBy("doc_id", _version().alias("__version")).agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return _without(kept, again).unionByName(one.select("__row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = contamination(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, judged.filter(contaminated(F.col("n_words"), F.col("n_hit"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, rate and copies of every document that is left, and how far it is from the targets.

    The classifier learns the languages of the documents in ``labels``.
    """
    labelled = read(spark, sf_dir, "labels").select("doc_id").distinct()
    languages = docs.join(labelled, "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))
    return mix_to_targets(docs, languages, TARGETS).select("doc_id", "source", "n_tokens", "rate", "copies", "gap")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Perplexities and the fit of the rates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
