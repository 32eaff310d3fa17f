"""Fill-in-middle transformation by a secondary sort of pieces.

A document is cut into lines, two of its line borders split it into prefix, middle and suffix, and the output puts the
middle last. Texts are never put together for this: every section is sent as pieces of whole lines, keyed by row and
output position. One shuffle by row, sorted within partitions, brings the pieces of a document into output order, where
they stream through an incremental digest. The same stream finds the sentinels again and gives each piece the position
it has in the original text; a second sort within the same partitions (no further shuffle) restores the text, which is
digested in turn. No task holds more than one batch of pieces, however long a document is.

Defined cases: a null text is empty. An empty text, one that holds a sentinel, and one that the rate leaves out are
plain: output and text are the same. A null doc_id is hashed as no digits. Rows that repeat a doc_id are documents
each (pieces are keyed by row, not by doc_id). A line longer than a piece is cut, wherever its bytes fall. Equal borders give an empty
middle. Empty tables give empty results; other columns of the input are not read. The row key numbers the rows of
each input partition, so give a scan, or a table that a repeated task finds in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 16
BATCH_BYTES = 4 << 20
# Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, MIDDLE, SUFFIX = range(3)  # in the order of the text
# A position in the restored text: section, then piece of the section.
SECTION_BITS = 48

_PIECE = pa.schema([("row", pa.int64()), ("position", pa.int64()), ("piece", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string())])
_PIECE_DDL = "row long, position long, piece binary, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string"
_DIGEST = pa.schema([*list(_PIECE)[3:], ("restored_sha256", pa.string())])
_DIGEST_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_TEXT = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("text", pa.string())])


class _Rows:
    """Rows gathered for the next batch, given out whenever they hold ``BATCH_BYTES``."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 100
        if self.size >= BATCH_BYTES:
            yield self.take()

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0
        return batch


def _chars(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all bytes but the continuing ones."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _runs(ends: np.ndarray, low: int, high: int, size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most ``size`` from ``low`` to ``high``, ending at line ends where they can; one empty range for an empty section."""
    while True:
        cut = min(low + size, high)
        if cut < high:
            k = int(np.searchsorted(ends, cut, "right"))
            cut = int(ends[k - 1]) if k and ends[k - 1] > low else cut
        yield low, cut
        low = cut
        if low >= high:
            return


def _cutter(seed: int, rate: int, spm: int, sentinels: tuple[str, str, str], piece_bytes: int):
    marks = [s.encode() for s in sentinels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECE)
        for batch in batches:
            for row, doc_id, value in zip(batch["row"], batch["doc_id"], batch["text"].cast(pa.binary()), strict=True):
                doc_id, data = doc_id.as_py(), value.as_py() or b""
                codes = np.frombuffer(data, np.uint8)
                ends = np.flatnonzero(codes == 10) + 1
                if len(data) and data[-1] != 10:
                    ends = np.append(ends, len(data))
                n = len(ends)
                digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
                h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
                if not data or any(m in data for m in marks) or h[2] % 100 >= rate:
                    form, lengths, sections = "plain", (None, None), [(b"", 0, len(data))]
                else:
                    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
                    lengths = _chars(codes[:first]), _chars(codes[first:second])
                    prefix, suffix, middle = (marks[0], 0, first), (marks[1], second, len(data)), (marks[2], first, second)
                    form, sections = ("spm", [suffix, prefix, middle]) if h[3] % 100 < spm else ("psm", [prefix, suffix, middle])
                position, about = 0, (doc_id, n, form, *lengths, None)
                for mark, low, high in sections:
                    for a, b in _runs(ends, low, high, piece_bytes):
                        yield from out.add((row.as_py(), position, mark + data[a:b], *about), b - a)
                        position, mark, about = position + 1, b"", (None,) * 6
        yield out.take()

    return run


def cut(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The pieces of every document's output: row, position in the output and bytes; what is known of the document comes with its first piece.

    ``rate``: percentage of documents that are transformed, ``spm``: percentage of those that begin with the suffix.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_cutter(seed, rate, spm, sentinels, piece_bytes), _PIECE_DDL)


def _in_order(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("row").sortWithinPartitions("row", "position")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each document of sorted pieces: its first row, and its pieces one after another."""
    rows = ({"row": r, "at": k, "batch": b} for b in batches for k, r in enumerate(b["row"].to_pylist()))
    ahead = next(rows, None)

    def pieces(row: int) -> Iterator[bytes]:
        nonlocal ahead
        while ahead and ahead["row"] == row:
            yield ahead["batch"]["piece"][ahead["at"]].as_py()
            ahead = next(rows, None)

    while ahead:
        first = {name: ahead["batch"][name][ahead["at"]].as_py() for name in _PIECE.names if name != "piece"}
        stream = pieces(first["row"])
        yield first, stream
        for _ in stream:
            pass


def _output_digester(sentinels: tuple[str, str, str]):
    """Digests of the outputs; pieces go on without sentinels, at the positions that the output alone tells."""
    sections = dict(zip((s.encode() for s in sentinels), (PREFIX, SUFFIX, MIDDLE), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECE)
        for first, pieces in _streams(batches):
            digest, section, count = hashlib.sha256(), PREFIX, 0
            for piece in pieces:
                digest.update(piece)
                mark = next((m for m in sections if piece.startswith(m)), None) if first["form"] != "plain" else None
                if mark:
                    section, piece = sections[mark], piece[len(mark) :]
                count += 1
                yield from out.add((first["row"], (section << SECTION_BITS) + count, piece, *(None,) * 6), len(piece))
            about = (first[name] for name in ("doc_id", "n", "form", "prefix_chars", "middle_chars"))
            yield from out.add((first["row"], -1, b"", *about, digest.hexdigest()))
        yield out.take()

    return run


def _restored_digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(_DIGEST)
    for first, pieces in _streams(batches):
        digest = hashlib.sha256()
        for piece in pieces:
            digest.update(piece)
        yield from out.add((*(first[name] for name in _DIGEST.names[:-1]), digest.hexdigest()))
    yield out.take()


def digests(pieces: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Per document: lines, form, lengths, and the digests of the output and of the text rebuilt from it."""
    outputs = _in_order(pieces).mapInArrow(_output_digester(sentinels), _PIECE_DDL)
    return outputs.sortWithinPartitions("row", "position").mapInArrow(_restored_digester, _DIGEST_DDL)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(_TEXT)
    for first, pieces in _streams(batches):
        text = b"".join(pieces).decode()
        yield from out.add((first["doc_id"], first["form"], text), len(text))
    yield out.take()


def outputs(pieces: DataFrame) -> DataFrame:
    """The transformed texts: (doc_id, form, text), one row per document, to train on."""
    return _in_order(pieces).mapInArrow(_joined, "doc_id long, form string, text string")
