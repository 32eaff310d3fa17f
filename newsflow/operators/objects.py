"""Output files under names of their own, written in two phases.

``<root>/ingest_dt=YYYY/MM/DD/hour=HH/part=<start>-<end>/<writer>-seq=NNNNNN.ndjson``. Each file holds the rows that a
writer would put there which closes it at the size limit (see ``rotation``), so one task per file is bounded. Tasks write
below ``_staging``, which readers skip; the driver then notes what is to become visible, moves the files, and notes that it
is done. A failed job leaves nothing visible. A driver that stops between the notes is caught up with by the next run
(``recover``). While files of a window are being moved, its folder holds a marker.

A run of the same ``run`` replaces what it wrote before. With ``carry`` a numbered run goes on with the file that the run
before left open: the file then has a piece per run, ``<writer>-seq=NNNNNN.<run>.ndjson``, and many small runs fill it up
to the limit.

Rejected messages may go along: their files lie below ``_quarantine/reason=<reason>``, which readers of the records skip. They are
rotated, carried, replaced and committed with the records, so both become visible or neither.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .. import schema
from ..functions import times
from .records import to_ndjson
from .windows import DEFAULT_MAX_OBJECT_BYTES, PARTITION_COLUMNS, assign_windows, rotate_files

# --- fixed values -----------------------------------------------------------------------------
MARKER = "uploading.marker"
FILE_NAME = "{writer}-seq={seq:06d}{piece}.ndjson"
# ----------------------------------------------------------------------------------------------
STAGING, MANIFESTS = "_staging", "_manifests"
QUARANTINE = "_quarantine"
REJECTED = "raw string, reason string, errors array<struct<field: string, sent: string, wanted: string>>"
PART_MARK = ".at-"  # before the offset of a part of a larger file
_COLUMNS = "prefix string, file_seq long, line string"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


def _write_text(system: fs.FileSystem, path: str, text: str) -> None:
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(text.encode())


def _read_json(system: fs.FileSystem, path: str) -> dict | None:
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    with system.open_input_stream(path) as file:
        return json.loads(file.read())


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: (window folder, number, staged path, bytes)."""

    files: list[tuple[str, int, str, int]] = field(default_factory=list)


class ObjectFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "newsflow_objects"

    def schema(self) -> str:
        return _COLUMNS

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(dict(self.options))


class ObjectWriter(DataSourceArrowWriter):
    """Rows come sorted by folder and number, all rows of a file in one task."""

    def __init__(self, options: dict[str, str]):
        self.uri, self.name, self.run = options["path"], options["name"], options["run"]
        self.carry = options["carry"] == "true"
        # The folder of a row is the whole name of its file.
        self.keyed = options.get("keyed") == "true"

    def _staging(self) -> str:
        return f"{STAGING}/{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, root = _opened(self.uri)
        attempt = TaskContext.get().taskAttemptId()
        done, current, out, size = Staged(), None, None, 0
        try:
            for batch in iterator:
                prefixes, numbers, lines = (batch.column(k).to_pylist() for k in range(3))
                low = 0
                for high in range(1, len(lines) + 1):
                    if high < len(lines) and (prefixes[high], numbers[high]) == (prefixes[low], numbers[low]):
                        continue
                    if (prefixes[low], numbers[low]) != current:
                        if out:
                            out.close()
                            done.files[-1] = (*done.files[-1][:3], size)
                        current, size = (prefixes[low], numbers[low]), 0
                        path = f"{self._staging()}/{attempt}-{len(done.files)}"
                        system.create_dir(f"{root}/{self._staging()}", recursive=True)
                        out = system.open_output_stream(f"{root}/{path}")
                        done.files.append((*current, path, 0))
                    data = ("\n".join(lines[low:high]) + "\n").encode()
                    out.write(data)
                    size += len(data)
                    low = high
            if out:
                out.close()
                done.files[-1] = (*done.files[-1][:3], size)
        except BaseException:
            if out and not out.closed:
                out.close()
            raise
        return done

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = _opened(self.uri)
        staged = sorted(f for m in messages if m for f in m.files)
        before = _manifest_before(system, root, self.run) if self.carry else None
        held = dict((before or {}).get("open", {}))
        last: dict[str, list[int]] = {}
        for prefix, number, _, size in staged:
            if prefix not in last or last[prefix][0] < number:
                carried = held[prefix][1] if prefix in held and held[prefix][0] == number else 0
                last[prefix] = [number, size + carried]
        piece = f".{self.run}" if self.carry else ""
        name = lambda prefix, number: prefix if self.keyed else f"{prefix}/{FILE_NAME.format(writer=self.name, seq=number + 1, piece=piece)}"
        moves = [[path, name(prefix, number), size] for prefix, number, path, size in staged]
        earlier = _read_json(system, _manifest(root, self.run)) or {}
        kept = {to for _, to, _ in moves}
        gone = [f for f, _ in (earlier.get("files", []) if not self.keyed else _other_parts(system, root, kept)) if f not in kept]
        note = {"run": self.run, "files": [m[1:] for m in moves], "moves": moves, "gone": gone, "open": {} if self.keyed else held | last}
        _write_text(system, f"{_manifest(root, self.run)}.pending", json.dumps(note))
        _finish(system, root, note)

    def abort(self, messages: list[Staged | None]) -> None:
        system, root = _opened(self.uri)
        _delete(system, f"{root}/{self._staging()}")


def _whole(key: str) -> str:
    return re.sub(re.escape(PART_MARK) + r"\d{15}(\.[^./]*)$", r"\1", key)


def _other_parts(system: fs.FileSystem, root: str, keys: set[str]) -> Iterator[tuple[str, int]]:
    """Files of the same wholes as ``keys``: what is left of an earlier form that had other parts."""
    wholes = {_whole(k) for k in keys}
    for folder in sorted({k.rpartition("/")[0] for k in keys}):
        for found in system.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True)):
            key = f"{folder}/{found.base_name}".lstrip("/")
            if found.type == fs.FileType.File and _whole(key) in wholes:
                yield key, found.size


def _delete(system: fs.FileSystem, path: str) -> None:
    kind = system.get_file_info(path).type
    if kind == fs.FileType.Directory:
        system.delete_dir(path)
    elif kind == fs.FileType.File:
        system.delete_file(path)


def _manifest(root: str, run: str) -> str:
    return f"{root}/{MANIFESTS}/{run}.json"


def _runs(system: fs.FileSystem, root: str, ending: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True))
    return [f.base_name.removesuffix(ending) for f in found if f.base_name.endswith(ending)]


def _manifest_before(system: fs.FileSystem, root: str, run: str) -> dict | None:
    """The note of the last numbered run before this one."""
    numbers = [int(r) for r in _runs(system, root, ".json") if r.isdigit() and int(r) < int(run)]
    return _read_json(system, _manifest(root, str(max(numbers)))) if numbers else None


def _finish(system: fs.FileSystem, root: str, note: dict) -> None:
    """Make the files of a note visible. May be repeated: files that are moved already are left alone."""
    folders = sorted({to.rpartition("/")[0] or "." for _, to, _ in note["moves"]})
    for folder in folders:
        _write_text(system, f"{root}/{folder}/{MARKER}", "")
    for path, to, _ in note["moves"]:
        if system.get_file_info(f"{root}/{path}").type == fs.FileType.File:
            system.move(f"{root}/{path}", f"{root}/{to}")
    for file in note["gone"]:
        _delete(system, f"{root}/{file}")
    _write_text(system, _manifest(root, note["run"]), json.dumps({k: v for k, v in note.items() if k not in ("moves", "gone")}))
    for folder in folders:
        _delete(system, f"{root}/{folder}/{MARKER}")
    _delete(system, f"{_manifest(root, note['run'])}.pending")
    _delete(system, f"{root}/{STAGING}/{note['run']}")


def recover(uri: str) -> list[str]:
    """Finish runs whose driver stopped while it moved files; returns their names. Safe to call at any time between runs."""
    system, root = _opened(uri)
    found = sorted(_runs(system, root, ".json.pending"))
    for run in found:
        _finish(system, root, _read_json(system, f"{_manifest(root, run)}.pending"))
    return found


def open_files(spark: SparkSession, uri: str, run: int) -> DataFrame:
    """(part, file_seq, bytes) of the file that the run before ``run`` left open in each window: one row per window, and one
    per reason of rejects."""
    system, root = _opened(uri)
    before = _manifest_before(system, root, str(run)) or {"open": {}}
    rows = [(prefix.rpartition("/part=")[2], number, size) for prefix, (number, size) in before["open"].items()]
    return spark.createDataFrame(rows, "part string, file_seq long, bytes long")


def write_objects(
    records: DataFrame,
    uri: str,
    *,
    writer: str = "newsflow",
    ingest_ts: str = "ingest_ts",
    minutes: int = times.DEFAULT_WINDOW_MINUTES,
    max_object_bytes: int = DEFAULT_MAX_OBJECT_BYTES,
    run: int | str | None = None,
    carry: bool = False,
    slices: int | None = None,
    rejects: DataFrame | None = None,
) -> None:
    """Write records as one file per window and file number; ``uri`` is any that Arrow's file systems open.

    ``rejects`` (raw, reason, errors and ``ingest_ts``) are written and committed with them, one file per reason and number.

    ``run`` names what a later run of the same name replaces; without it the files carry a name of their own. ``carry`` needs a
    number, like that of a micro-batch, and continues open files.
    """
    if carry and not isinstance(run, int):
        raise ValueError("open files are carried between numbered runs")
    spark = records.sparkSession
    spark.dataSource.register(ObjectFiles)
    recover(uri)
    name = writer if carry else f"{writer}-{uuid.uuid4().hex if run is None else run}"
    order = (ingest_ts, "news_id", "pos")
    placed = assign_windows(to_ndjson(records), ingest_ts, minutes).select(*PARTITION_COLUMNS, *order, "bytes", "line")
    if rejects is not None:
        placed = placed.unionByName(_placed_rejects(rejects, ingest_ts))
    rotated = rotate_files(placed, max_object_bytes, order, slices, open_files(spark, uri, run) if carry else None)
    window = F.concat(F.lit("ingest_dt="), F.translate("ingest_dt", "-", "/"), F.lit("/hour="), "hour", F.lit("/part="), "part")
    prefix = F.coalesce(window, "part").alias("prefix")  # rejects have no window
    files = rotated.select(prefix, "file_seq", "line", *order).repartition("prefix", "file_seq").sortWithinPartitions("prefix", "file_seq", *order)
    options = {"path": uri, "name": name, "run": str(name if run is None else run), "carry": str(carry).lower()}
    files.select("prefix", "file_seq", "line").write.format(ObjectFiles.name()).options(**options).mode("append").save()


def _placed_rejects(rejects: DataFrame, ingest_ts: str) -> DataFrame:
    """Rejects as rows for the rotation: the folder of their reason takes the place of the window, a hash that of the order."""
    line = F.to_json(F.struct("raw", "reason", "errors"), {"ignoreNullFields": "false"})
    none = F.lit(None).cast("string")
    return rejects.select(
        none.alias("ingest_dt"),
        none.alias("hour"),
        F.concat(F.lit(f"{QUARANTINE}/reason="), "reason").alias("part"),
        ingest_ts,
        F.xxhash64("raw").alias("news_id"),
        F.lit(0).alias("pos"),
        (F.octet_length(line) + 1).cast("bigint").alias("bytes"),
        line.alias("line"),
    )


def read_rejects(spark: SparkSession, uri: str) -> DataFrame:
    """Rejected messages that were written with the records: raw, reason, errors."""
    reader = spark.read.schema(REJECTED).option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson")
    return reader.json(f"{uri.rstrip('/')}/{QUARANTINE}")


def write_keyed(rows: DataFrame, uri: str) -> None:
    """Write (key, line) rows as one file per ``key``, a path below ``uri``, in the order they are in; all rows of a key must be in
    one task and follow each other. Files that are there already are replaced, each as a whole."""
    rows.sparkSession.dataSource.register(ObjectFiles)
    recover(uri)
    run = uuid.uuid4().hex
    options = {"path": uri, "name": run, "run": run, "carry": "false", "keyed": "true"}
    shaped = rows.select(F.col("key").alias("prefix"), F.lit(0).cast("long").alias("file_seq"), "line")
    shaped.write.format(ObjectFiles.name()).options(**options).mode("append").save()


def read_objects(spark: SparkSession, uri: str) -> DataFrame:
    """Written records with the ``part`` and ``file_seq`` that their path names."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.RECORD.fields)
    reader = spark.read.schema(names).option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson")
    path = F.col("_metadata.file_path")
    seq = F.regexp_extract(path, r"-seq=(\d+)[^/]*$", 1).cast("long") - 1
    return reader.json(uri).select("*", F.regexp_extract(path, r"/part=([^/]+)/", 1).alias("part"), seq.alias("file_seq"))
