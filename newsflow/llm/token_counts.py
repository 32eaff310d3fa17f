"""Token counts of flat token files by a separator scan.

A token file is nothing but token identifiers, and one identifier ends each document; there is no index. Files are cut
into blocks, every block is searched for separators at once (a vectorised comparison), and tells how many there are, how
many tokens lie before the first and after the last, and the lengths between. Documents that cross blocks are stitched
by a prefix scan over these block summaries: a running count of separators numbers the documents, and the open tokens
since the last block with a separator are carried in. The scan runs in slices of blocks and over one total per slice,
so a file with a third of all blocks is no single task.

The files written here hold 2-byte big-endian identifiers and a header of five identifiers per document that encodes its
doc_id. Files of others are described by a ``TokenFormat``: width and byte order of an identifier, the separator, and the
length of a header, 0 for none. A header of another length than five is left out of the counts and gives no doc_id.

Files up to ``whole_bytes`` are read by Spark; of larger ones tasks read ranges of a few blocks, through the file systems
that Arrow opens, so a file of any size is spread and held in parts. The block summaries are stored, so files are read once.

Defined cases: a null or empty text is a document of no tokens, a null doc_id comes back as null, repeated rows are
documents each. A file may end without a separator; what is open then is a document if it holds any token, and counts none
beyond its header. A document may be longer than any number of blocks and slices. Empty files and tables give empty results.
A file whose bytes are no whole number of identifiers is an error.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm.tables import materialize
from newsflow.session import shared_dir

# The public split pattern of the byte-level vocabulary, and the place of that vocabulary on the executors.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Beyond the vocabulary's identifiers. Its two bytes are one UTF-8 character, so Spark's text sink can write it as the
# separator of lines, and lines are documents.
END = 0xC480
END_CHARACTER = "Ā"
TOKEN = np.dtype(">u2")
HEADER, DIGIT = 5, 15  # digits of a doc_id in a header, and bits of each: less than any special identifier
BLOCK_TOKENS = 1 << 19
SLICE_BLOCKS = 1024
DOCS_PER_FILE = 10_000
WHOLE_BYTES = 256 << 20
RANGE_BLOCKS = 32


@dataclass(frozen=True)
class TokenFormat:
    """Layout of flat token files: numpy type of an identifier, identifier that ends a document, length of a header."""

    token: str = TOKEN.str
    end: int = END
    header: int = HEADER

    def doc_id(self, header: np.ndarray) -> int | None:
        return _doc_id(header) if self.header == HEADER else None


@lru_cache(maxsize=2)
def _encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _header(doc_id: int | None) -> list[int]:
    number = 1 << 64 if doc_id is None else doc_id & 0xFFFFFFFFFFFFFFFF
    return [number >> (DIGIT * k) & ((1 << DIGIT) - 1) for k in range(HEADER)]


def _doc_id(header: np.ndarray) -> int | None:
    number = sum(int(d) << (DIGIT * k) for k, d in enumerate(header))
    return None if number >> 64 else number - (1 << 64) * (number >> 63)


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """Tokenize every whole text and write flat token files below ``path``, a folder all executors share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                rows = []
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    rows.append(np.array(_header(doc_id) + encoding.encode_ordinary(text or ""), TOKEN).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["tokens"])

    stream = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "tokens binary")
    stream.select(F.col("tokens").cast("string").alias("value")).write.option("lineSep", END_CHARACTER).option("maxRecordsPerFile", DOCS_PER_FILE).text(path)


_SUMMARY = "file string, block long, n_ends long, head long, tail long, lengths array<long>, ids array<long>, first_id long, open_id long, last boolean"
_TYPES = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, pa.int64(), pa.int64(), pa.bool_()]


def _rows(file: str, tokens: np.ndarray, first: int, n_tokens: int, block_tokens: int, n_blocks: int, form: TokenFormat) -> pa.RecordBatch:
    """Summaries of ``n_blocks`` blocks from number ``first`` on of a file of ``n_tokens``; ``tokens`` begins with the first of them."""
    rows = []
    for block in range(first, first + n_blocks):
        low = (block - first) * block_tokens
        high = min(low + block_tokens, n_tokens - first * block_tokens)
        rows.append((file, block, *_summary(tokens, low, high, block == 0, form), (block + 1) * block_tokens >= n_tokens))
    columns = zip(*rows, strict=True) if rows else [()] * len(_TYPES)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in _SUMMARY.split(", ")])


def _summary(tokens: np.ndarray, low: int, high: int, first: bool, form: TokenFormat) -> tuple:
    """What one block tells. Headers are read ahead where a document starts near its end."""
    ends = np.flatnonzero(tokens[low:high] == form.end)
    starts = ends + 1 + low
    ids = [form.doc_id(tokens[s : s + form.header]) if s < len(tokens) else None for s in starts.tolist()]
    head = int(ends[0]) if len(ends) else high - low
    tail = high - low - int(ends[-1]) - 1 if len(ends) else high - low
    opening = form.doc_id(tokens[: form.header]) if first else None
    return len(ends), head, tail, np.diff(ends).astype(np.int64) - 1, ids[:-1], opening, ids[-1] if ids else opening


def _whole_files(block_tokens: int, form: TokenFormat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                tokens = np.frombuffer(content.as_buffer(), form.token)
                yield _rows(name.as_py(), tokens, 0, len(tokens), block_tokens, -(-len(tokens) // block_tokens), form)

    return run


def _ranges(block_tokens: int, form: TokenFormat):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(form.token).itemsize
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['path']}: not a whole number of identifiers")
                n_tokens, first = row["length"] // width, row["first"]
                n_blocks = min(row["n_blocks"], -(-n_tokens // block_tokens) - first)
                # s3a, as Spark calls it, is s3 to Arrow.
                system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", row["path"]))
                with system.open_input_file(path) as file:
                    data = file.read_at((n_blocks * block_tokens + form.header) * width, first * block_tokens * width)
                yield _rows(row["path"], np.frombuffer(data, form.token), first, n_tokens, block_tokens, n_blocks, form)

    return run


def _summaries(spark: SparkSession, path: str, block_tokens: int, whole_bytes: int, form: TokenFormat, glob: str) -> DataFrame:
    """One row per block of the files below ``path``. The names and lengths of files that are read by ranges are a table, not a list."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).filter("length > 0")
    whole = files.filter(F.col("length") <= whole_bytes).select("path", "content").mapInArrow(_whole_files(block_tokens, form), _SUMMARY)
    range_bytes = RANGE_BLOCKS * block_tokens * np.dtype(form.token).itemsize
    firsts = F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))
    large = files.filter(F.col("length") > whole_bytes).select("path", "length", F.explode(firsts).alias("part"))
    parts = large.select("path", "length", (F.col("part") * RANGE_BLOCKS).alias("first"), F.lit(RANGE_BLOCKS).alias("n_blocks"))
    return whole.union(parts.repartition("path", "first").mapInArrow(_ranges(block_tokens, form), _SUMMARY))


def count_tokens(
    spark: SparkSession,
    path: str,
    block_tokens: int = BLOCK_TOKENS,
    slice_blocks: int = SLICE_BLOCKS,
    *,
    form: TokenFormat = TokenFormat(),  # noqa: B008
    whole_bytes: int = WHOLE_BYTES,
    glob: str = "part-*",
) -> DataFrame:
    """(file, ordinal, doc_id, n_tokens) for every document in the token files below ``path`` that match ``glob``.

    The files are read while this is called.
    """
    summaries = materialize(_summaries(spark, path, block_tokens, whole_bytes, form, glob), "token-blocks")
    blocks = summaries.withColumn("slice", F.floor(F.col("block") / slice_blocks))

    has_end = F.col("n_ends") > 0
    starts = has_end | (F.col("block") == 0)
    inside = Window.partitionBy("file", "slice").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    local = (
        blocks.withColumn("open", zero(F.sum("tail").over(before)))
        .withColumn("ends_before", zero(F.sum("n_ends").over(before)))
        # open tokens up to the last block with a separator, whose own tail stays open
        .withColumn("closed", F.last(F.when(has_end, F.col("open")), ignorenulls=True).over(before))
        .withColumn("id_before", F.last(F.when(starts, F.struct("open_id")), ignorenulls=True).over(before))
    )
    # One total per slice, scanned the same way.
    totals = local.groupBy("file", "slice").agg(
        F.sum("n_ends").alias("n_ends"),
        F.max_by(F.struct((F.col("open") + F.col("tail") - F.when(has_end, F.col("open")).otherwise(zero(F.col("closed")))).alias("n")), "block").alias("tail"),
        F.max_by(F.when(starts, F.struct("open_id")).otherwise(F.col("id_before")), "block").alias("open_id"),
    )
    over = Window.partitionBy("file").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.select("file", "slice", "n_ends", F.col("tail.n").alias("tail"), "open_id")
        .withColumn("slice_open", zero(F.sum("tail").over(over)))
        .withColumn("slice_ends", zero(F.sum("n_ends").over(over)))
        .withColumn("slice_closed", zero(F.last(F.when(F.col("n_ends") > 0, F.col("slice_open")), ignorenulls=True).over(over)))
        .withColumn("slice_id", F.last("open_id", ignorenulls=True).over(over))
        .select("file", "slice", "slice_ends", (F.col("slice_open") - F.col("slice_closed")).alias("slice_carry"), "slice_id")
    )
    stitched = local.join(carried, ["file", "slice"])
    carry = F.when(F.col("closed").isNotNull(), F.col("open") - F.col("closed")).otherwise(F.col("open") + F.col("slice_carry"))
    owner = F.coalesce("id_before", "slice_id")["open_id"]
    whole = F.struct((carry + F.col("head")).alias("n"), F.coalesce("first_id", owner).alias("id"))
    left_open = F.struct(F.col("tail").alias("n"), F.col("open_id").alias("id"))
    inner = F.arrays_zip(F.col("lengths").alias("n"), F.col("ids").alias("id"))
    at_end = F.when(F.col("last") & (F.col("tail") > 0), F.array(left_open))
    none = F.array().cast("array<struct<n:bigint,id:bigint>>")
    found = F.when(has_end, F.concat(F.array(whole), inner, F.coalesce(at_end, none))).otherwise(F.when(F.col("last"), F.array(whole)).otherwise(none))
    return stitched.select("file", (F.col("slice_ends") + F.col("ends_before")).alias("first"), F.posexplode(found).alias("k", "doc")).select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), F.col("doc.id").alias("doc_id"), F.greatest(F.col("doc.n") - form.header, F.lit(0)).alias("n_tokens")
    )


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files below the shared one."""
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
