import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsflow.operators import objects, records
from newsflow.operators.objects import MARKER, read_objects, recover, write_objects
from newsflow.plans.pipeline import articles_to_records, run_batch
from newsflow.operators.archive import backfill, migrate
from newsflow.operators import ingest
from newsflow.sources import stream_messages
from newsflow.sources.files import read_archive
from newsflow.streaming.job import start

from .messages import frame, message
from .test_sinks import record_rows


def names(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*.ndjson") if "_staging" not in p.parts)


def hidden(root):
    return [p for p in Path(root).rglob("*") if p.is_file() and ("_staging" in p.parts or p.name == MARKER or p.name.endswith(".pending"))]


FOLDER = "ingest_dt=2025/10/02/hour=18/part=20251002_1800-20251002_1829"


def test_names_sizes_and_order(spark, tmp_path):
    rows = record_rows(spark, 40)
    write_objects(rows, str(tmp_path), writer="host", run="a", max_object_bytes=1000, slices=5)
    assert names(tmp_path) == [f"{FOLDER}/host-a-seq={k:06d}.ndjson" for k in range(1, 11)] and not hidden(tmp_path)
    ids = [json.loads(line)["news_id"] for name in names(tmp_path) for line in (tmp_path / name).read_text().splitlines()]
    assert ids == list(range(40))
    sizes = [(tmp_path / name).stat().st_size for name in names(tmp_path)]
    assert all(s >= 1000 for s in sizes[:-1]) and sum(sizes) == records.to_ndjson(rows).agg(F.sum("bytes")).first()[0]
    back = read_objects(spark, str(tmp_path))
    assert {r.file_seq for r in back.collect()} == set(range(10)) and back.count() == 40
    assert read_archive(spark, str(tmp_path)).count() == 40


def test_a_failed_job_leaves_nothing_visible(spark, tmp_path):
    write_objects(record_rows(spark, 3), str(tmp_path), run="good")
    before = names(tmp_path)
    # The rows are fine up to the sink, where one task of several fails after it has written.
    fails = objects.ObjectWriter.write

    class Broken(objects.ObjectFiles):
        def writer(self, schema, overwrite):
            return Failing(dict(self.options))

    class Failing(objects.ObjectWriter):
        def write(self, iterator):
            done = fails(self, iterator)
            if any("_1830" in f[0] for f in done.files):
                raise OSError("no space")
            return done

    good, bad = record_rows(spark, 5), record_rows(spark, 5, "2025-10-02 18:31:00")
    original, objects.ObjectFiles = objects.ObjectFiles, Broken
    try:
        with pytest.raises(Exception, match="no space"):
            write_objects(good.union(bad), str(tmp_path), run="bad")
    finally:
        objects.ObjectFiles = original
    assert names(tmp_path) == before and not hidden(tmp_path)


def test_same_run_replaces_and_others_add(spark, tmp_path):
    write_objects(record_rows(spark, 40), str(tmp_path), run="x", max_object_bytes=1000)
    write_objects(record_rows(spark, 8), str(tmp_path), run="x", max_object_bytes=1000)
    assert len(names(tmp_path)) == 2 and read_objects(spark, str(tmp_path)).count() == 8
    for _ in range(2):
        write_objects(record_rows(spark, 2), str(tmp_path))
    assert len(names(tmp_path)) == 4 and read_objects(spark, str(tmp_path)).count() == 12


def test_a_driver_that_stopped_is_caught_up_with(spark, tmp_path, monkeypatch):
    moved = []

    def stops(system, root, note):
        system.create_dir(f"{root}/{FOLDER}", recursive=True)
        path, to, _ = note["moves"][0]
        system.move(f"{root}/{path}", f"{root}/{to}")
        moved.append(to)
        raise KeyboardInterrupt

    monkeypatch.setattr(objects, "_finish", stops)
    writer = objects.ObjectWriter({"path": str(tmp_path), "name": "host", "run": "r", "carry": "false"})
    (tmp_path / "_staging" / "r").mkdir(parents=True)
    for k in range(3):
        (tmp_path / "_staging" / "r" / str(k)).write_text(f'{{"n":{k}}}\n')
    with pytest.raises(KeyboardInterrupt):
        writer.commit([objects.Staged([(FOLDER, k, f"_staging/r/{k}", 8) for k in range(3)]), None])
    assert len(names(tmp_path)) == len(moved) == 1
    monkeypatch.undo()
    assert recover(str(tmp_path)) == ["r"] and recover(str(tmp_path)) == []
    assert len(names(tmp_path)) == 3 and not hidden(tmp_path)


def totals(root):
    out = {}
    for name in names(root):
        seq = name.split("-seq=")[1][:6]
        out[seq] = out.get(seq, 0) + (Path(root) / name).stat().st_size
    return out


def test_many_small_runs_fill_files_up(spark, tmp_path):
    rows = record_rows(spark, 40)
    parts = [rows.where(F.col("news_id").between(low, low + 5)) for low in range(0, 40, 6)]
    for k, part in enumerate(parts):
        write_objects(part, str(tmp_path / "live"), writer="host", run=k, carry=True, max_object_bytes=1000)
    write_objects(rows, str(tmp_path / "batch"), writer="host", run="all", max_object_bytes=1000)
    assert totals(tmp_path / "live") == totals(tmp_path / "batch") and len(names(tmp_path / "live")) > 10
    live, batch = (read_objects(spark, str(tmp_path / n)).select("news_id", "part", "file_seq") for n in ("live", "batch"))
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()
    # A run that is repeated finds the same open files and gives the same names.
    before = names(tmp_path / "live")
    write_objects(parts[-1], str(tmp_path / "live"), writer="host", run=len(parts) - 1, carry=True, max_object_bytes=1000)
    assert names(tmp_path / "live") == before and totals(tmp_path / "live") == totals(tmp_path / "batch")
    with pytest.raises(ValueError):
        write_objects(rows, str(tmp_path / "live"), carry=True)


def test_stream_fills_files_over_its_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(4):
        (landing / f"{k}.json").write_text("\n".join(message({"id": 5 * k + j}, securities=["A"]) for j in range(5)) + "\n")
    query = start(stream_messages(spark, str(landing), 1), str(tmp_path / "out"), str(tmp_path / "no"), str(tmp_path / "state"), available_now=True, writer="live", max_object_bytes=2000)
    query.awaitTermination()
    windows = {}
    for name in names(tmp_path / "out"):
        folder, file = name.rsplit("/", 1)
        windows.setdefault(folder, {}).setdefault(file[:15], []).append((tmp_path / "out" / name).stat().st_size)
    assert read_objects(spark, str(tmp_path / "out")).count() == 20
    # The batches of one window (two, if the half hour passed meanwhile) share files: all but the last are full.
    for files in windows.values():
        assert all(sum(files[f]) >= 2000 for f in sorted(files)[:-1])
    assert any(len(sizes) > 1 for files in windows.values() for sizes in files.values())


def test_bodies_stay_whole_where_no_summary_failed(spark, tmp_path):
    body = "word " * 1000
    raws = [message({"id": 1}, body=body, securities=["A"])]
    run_batch(frame(spark, *raws), str(tmp_path / "batch"), str(tmp_path / "no"), writer="host", batch_id="b")
    assert read_objects(spark, str(tmp_path / "batch")).first().content == body.strip()
    articles = ingest.accepted(ingest.parse_messages(frame(spark, *raws)))
    assert len(articles_to_records(articles, None).first().content) == 4999
    assert len(articles_to_records(articles, None, fallback_chars=50).first().content) <= 50
    failing = articles_to_records(articles, Failing, fallback_chars="where-summary-failed").first()
    assert len(failing.content) == 1000
    legacy = [(json.dumps({"news_id": 1, "timestamp": "2025-10-02T18:00:00Z", "ticker": "A", "body": body}), "p", 0, 0)]
    lines = spark.createDataFrame(legacy, "line string, path string, block long, line_no long")
    assert migrate(lines).first().content == body.strip() == backfill(lines).first().content


class Failing:
    def __call__(self):
        return None

    def __new__(cls):
        def call(request):
            raise RuntimeError("down")

        return call
