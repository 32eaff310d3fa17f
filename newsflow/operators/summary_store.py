"""Stored summaries of any number of articles, asked without moving the store.

A store is a folder. ``summaries-<generation>`` is a Parquet table in buckets by (news_id, prompt_hash); only the distinct
keys of the articles are dealt to its buckets. ``known-<generation>`` is a Bloom filter in blocks of 256 bits, one row per
block and change; the blocks of several changes merge by bitwise or. Articles it does not know skip the match. ``manifest``
has one row per generation, written last: a compaction that stops half-way changes nothing.

One job at a time may change a store, any number may read it. The buckets are known to the session's catalog only
while a store is open; nothing else depends on the catalog.

Defined cases: articles without a prompt are never known. Several summaries of one key: the smallest. An addition that runs
again leaves rows that count once, until a compaction removes them. An empty store knows nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

KEYS = ("news_id", "prompt_hash")
ROWS = "news_id BIGINT, prompt_hash STRING, summary STRING"
WORDS = ("w0", "w1", "w2", "w3")
BLOCK = "block BIGINT, w0 BIGINT, w1 BIGINT, w2 BIGINT, w3 BIGINT"
MANIFEST = "generation INT, buckets INT, blocks BIGINT"
BITS_PER_KEY = 8
# Rows of the filter that may be broadcast, each of 40 bytes; a store of more blocks does without the filter.
BROADCAST_BLOCKS = 1 << 20
DEFAULT_BLOCKS = 1 << 18


def _words(news_id: Column, prompt_hash: Column) -> list[Column]:
    """The bits of a key within its block, as four words of 64."""
    drawn = F.xxhash64(prompt_hash, news_id, F.lit(1))
    words = []
    for word in range(len(WORDS)):
        bits = F.lit(0).cast("long")
        for k in range(BITS_PER_KEY):
            place = F.shiftrightunsigned(drawn, 8 * k).bitwiseAND(F.lit(255).cast("long")).cast("int")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)
            bits = bits.bitwiseOR(F.when(F.floor(place / 64) == word, bit).otherwise(F.lit(0).cast("long")))
        words.append(bits)
    return words


def _block(news_id: Column, prompt_hash: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(news_id, prompt_hash), F.lit(blocks).cast("long"))


def _filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The Bloom filter of ``keys``: one row per block that holds any."""
    key = [F.col(k) for k in KEYS]
    bits = keys.select(_block(*key, blocks).alias("block"), *[c.alias(w) for c, w in zip(_words(*key), WORDS, strict=True)])
    return bits.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def _ask(articles: DataFrame, known: DataFrame, blocks: int) -> DataFrame:
    """Add ``_maybe``: the filter ``known``, which is broadcast, may hold (id, prompt_hash)."""
    key = (F.col("id").cast("long"), F.col("prompt_hash"))
    sent = F.broadcast(known.select(F.col("block").alias("_block"), *[F.col(w).alias(f"_{w}") for w in WORDS]))
    hit = F.lit(True)
    for word, name in zip(_words(*key), WORDS, strict=True):
        hit = hit & (F.col(f"_{name}").bitwiseAND(word) == word)
    met = articles.withColumn("_at", _block(*key, blocks)).join(sent, F.col("_at") == F.col("_block"), "left")
    return met.select(*articles.columns, (F.col("prompt_hash").isNotNull() & F.coalesce(hit, F.lit(False))).alias("_maybe"))


@dataclass(frozen=True)
class SummaryStore:
    spark: SparkSession
    root: str
    generation: int
    buckets: int
    blocks: int

    @property
    def table(self) -> str:
        return f"summaries_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{self.generation}"

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}-{self.generation:06d}"

    def _register(self) -> SummaryStore:
        """Tell the session how the files are bucketed; also forgets files that it listed earlier."""
        keys = ", ".join(KEYS)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.spark.sql(
            f"CREATE TABLE {self.table} ({ROWS}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self._folder('summaries')}'"
        )
        return self

    def _block(self, news_id: Column, prompt_hash: Column) -> Column:
        return _block(news_id, prompt_hash, self.blocks)

    def rows(self) -> DataFrame:
        """One summary per key; keeps to the buckets, so neither this nor a match on the keys moves the store."""
        return self.spark.table(self.table).groupBy(*KEYS).agg(F.min("summary").alias("summary"))

    def known(self) -> DataFrame:
        """The filter: one row per block that holds any key."""
        changes = self.spark.read.schema(BLOCK).parquet(self._folder("known"))
        return changes.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])

    def add(self, made: DataFrame) -> None:
        """Add (news_id, prompt_hash, summary) rows, such as those of ``enrich.summary_store``.

        The filter goes first: if the job stops in between, keys are asked for in vain but none is overlooked.
        """
        new = materialize(made.where(F.col("prompt_hash").isNotNull() & F.col("summary").isNotNull()).select(F.col("news_id").cast("long"), "prompt_hash", "summary"), "new-summaries")
        self._write_known(new)
        self._write_rows(new)

    def _write_known(self, keys: DataFrame) -> None:
        _filter(keys, self.blocks).write.mode("append").parquet(self._folder("known"))

    def _write_rows(self, rows: DataFrame) -> None:
        # Dealt as the buckets are, so that each bucket gets one file per change.
        rows.repartition(self.buckets, *KEYS).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def compact(self, buckets: int | None = None, blocks: int | None = None) -> SummaryStore:
        """A new generation with one row per key and one file per bucket; also the way to other numbers of both."""
        new = SummaryStore(self.spark, self.root, self.generation + 1, buckets or self.buckets, blocks or self.blocks)
        for name in ("summaries", "known"):  # what an attempt that stopped may have left
            _clear(self.spark, new._folder(name))
        new._register()._write_rows(self.rows())
        new._write_known(new.rows().select(*KEYS))
        new._commit()
        return new

    def _commit(self) -> None:
        row = [(self.generation, self.buckets, self.blocks)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def remove_older(self) -> None:
        """Delete the generations before this one; call it when no job reads them any more."""
        for generation in range(self.generation):
            old = SummaryStore(self.spark, self.root, generation, self.buckets, self.blocks)
            self.spark.sql(f"DROP TABLE IF EXISTS {old.table}")
            for name in ("summaries", "known"):
                _clear(self.spark, old._folder(name))

    def attach(self, articles: DataFrame) -> DataFrame:
        """Add ``_known``, the stored summary of (id, prompt_hash), to ``articles``.

        They are stored once, apart by what the filter says. Those it does not know go on as they are. Of the others the
        distinct keys meet the buckets, however often an article repeats, and what is found comes back by a join that Spark may
        broadcast or split.
        """
        asked = articles.withColumn("_maybe", F.col("prompt_hash").isNotNull())
        if self.blocks <= BROADCAST_BLOCKS:
            asked = _ask(articles, self.known(), self.blocks)
        stored = materialize(asked, "asked-articles", "_maybe")
        maybe = stored.where("_maybe").drop("_maybe")
        keys = maybe.select(F.col("id").cast("long").alias("news_id"), "prompt_hash").distinct()
        found = materialize(keys.join(self.rows(), list(KEYS)), "found-summaries").select(
            F.col("news_id").alias("_news_id"), F.col("prompt_hash").alias("_hash"), F.col("summary").alias("_known")
        )
        same = (F.col("id").cast("long") == F.col("_news_id")) & (F.col("prompt_hash") == F.col("_hash"))
        matched = maybe.join(found, same, "left").select(*articles.columns, "_known")
        unknown = stored.where("NOT _maybe").select(*articles.columns, F.lit(None).cast("string").alias("_known"))
        return matched.unionByName(unknown)


def attach_table(articles: DataFrame, table: DataFrame, blocks: int = DEFAULT_BLOCKS) -> DataFrame:
    """Add ``_known``, the summary that ``table`` (news_id, prompt_hash, summary) has of (id, prompt_hash), to ``articles``.

    ``articles`` are read three times: pass a stored table. Their ``_text`` is shuffled only where a Bloom filter of the
    keys was wrong; it is NULL where there is a summary. Of a table of many more than 25 keys per block the filter knows
    little, and the texts are shuffled.
    """
    rows = table.select(F.col("news_id").cast("long").alias("_news_id"), F.col("prompt_hash").alias("_hash"), F.col("summary").alias("_known"))
    known = materialize(_filter(table.select(F.col("news_id").cast("long"), "prompt_hash"), blocks), "known")
    asked = _ask(articles, known, blocks)
    maybe, unknown = asked.where("_maybe").drop("_maybe"), asked.where("NOT _maybe").drop("_maybe")
    same = (F.col("id").cast("long") == F.col("_news_id")) & (F.col("prompt_hash") == F.col("_hash"))
    kept = [c for c in articles.columns if c != "_text"]
    matched = materialize(maybe.select(*kept).join(rows, same, "left").select(*kept, "_known"), "matched-articles")
    none = F.lit(None).cast("string")
    found = matched.where(F.col("_known").isNotNull()).withColumn("_text", none).select(*articles.columns, "_known")
    left = matched.where(F.col("_known").isNull()).select(F.col("id").alias("_id"), F.col("prompt_hash").alias("_hash")).distinct()
    # NULL ids are in the filter's reach as well, but match nothing in the table.
    missed = maybe.join(left, F.col("id").eqNullSafe(F.col("_id")) & (F.col("prompt_hash") == F.col("_hash")), "left_semi")
    return unknown.unionByName(missed).withColumn("_known", none).unionByName(found)


def _clear(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_store(spark: SparkSession, root: str, buckets: int = 200, blocks: int = DEFAULT_BLOCKS) -> SummaryStore:
    """A new store below ``root``.

    ``buckets``: about the size of all summaries by 200 MB, and no fewer than ``spark.sql.shuffle.partitions``, or Spark
    may prefer to deal both sides anew. ``blocks``: about the number of summaries by 25, for one article in a hundred that
    is asked for in vain.
    """
    store = SummaryStore(spark, root.rstrip("/"), 0, buckets, blocks)
    spark.createDataFrame([], BLOCK).write.parquet(store._folder("known"))
    store._register()
    store._commit()
    return store


def open_store(spark: SparkSession, root: str) -> SummaryStore:
    """The last complete generation of the store below ``root``."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    last = manifest.orderBy(F.desc("generation")).first()
    return SummaryStore(spark, root.rstrip("/"), last.generation, last.buckets, last.blocks)._register()
