import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from newsflow.operators import ingest, records, sinks, windows
from newsflow.plans.pipeline import articles_to_records, run_batch
from newsflow.session import run_folder, shared_dir

from .messages import frame, message
from .test_enrich import Recorder


def record_rows(spark, n, moment="2025-10-02 18:07:31"):
    raws = [message({"id": i}, body=f"body {i:03d}", securities=["A"]) for i in range(n)]
    articles = ingest.accepted(ingest.parse_messages(frame(spark, *raws)))
    return articles_to_records(articles, None).withColumn("ingest_ts", F.lit(moment).cast("timestamp"))


def files(root):
    return sorted(p for p in Path(root).rglob("*") if p.suffix == ".txt")


def test_layout_and_read_back(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = record_rows(spark, 3)
    sinks.write_windowed(rows, out)
    folders = {str(p.parent.relative_to(out)) for p in files(out)}
    assert folders == {"ingest_dt=2025-10-02/hour=18/part=20251002_1800-20251002_1829/seq=000000"}
    assert (tmp_path / "out" / "_SUCCESS").exists()
    back = sinks.read_records(spark, out)
    assert back.count() == 3 and back.where("hour = '18'").count() == 3
    same = [c for c in rows.columns if c not in ("ingest_ts", "pos")]
    assert back.select(same).exceptAll(rows.select(same)).isEmpty()
    assert back.first().created_at == datetime(2031, 5, 6, 6, 55)
    lines = [line for p in files(out) for line in p.read_text().splitlines()]
    assert [json.loads(line)["news_id"] for line in lines] == [0, 1, 2]


def test_rotation_overshoots_by_one_record_at_most(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = record_rows(spark, 40)
    sinks.write_windowed(rows, out, max_object_bytes=1000)
    sizes = {}
    for p in files(out):
        name = p.parent.name
        sizes[name] = sizes.get(name, 0) + p.stat().st_size
    longest = records.to_ndjson(rows).agg(F.max("bytes")).first()[0]
    # The writer's rule: a file is full before the next one begins, and ends beyond the limit by less than a record.
    assert len(sizes) == 10 and max(sizes.values()) < 1000 + longest
    assert all(sizes[name] >= 1000 for name in sorted(sizes)[:-1])
    assert sum(sizes.values()) == records.to_ndjson(rows).agg(F.sum("bytes")).first()[0]


def test_file_seq_does_not_depend_on_slices(spark):
    lines = windows.assign_windows(records.to_ndjson(record_rows(spark, 60)))
    one = windows.rotate_files(lines, 2000, slices=1).select("news_id", "file_seq")
    many = windows.rotate_files(lines, 2000, slices=9).select("news_id", "file_seq")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_named_runs_rotate_and_replace(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        sinks.write_windowed(record_rows(spark, 40), out, max_object_bytes=1000, batch_id="run")
    assert len({p.parent for p in files(out)}) == 10 and sinks.read_records(spark, out).count() == 40
    assert all(p.parent.name.startswith("seq=batch-run-") for p in files(out))


def test_rotation_stores_narrow_rows(spark, tmp_path):
    with run_folder(spark) as folder:
        sinks.write_windowed(record_rows(spark, 4), str(tmp_path / "out"))
        stored = spark.read.parquet(f"{folder}/running-total-*").columns
    assert not {"content", "title", "authors"} & set(stored) and "line" in stored


def test_half_open_windows(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_windowed(record_rows(spark, 1, "2025-10-02 18:29:59.9"), out, max_object_bytes=None)
    sinks.write_windowed(record_rows(spark, 1, "2025-10-02 18:30:00"), out, max_object_bytes=None)
    assert len({p.parent for p in files(out)}) == 2


def test_batch_job_calls_once_and_can_be_replayed(spark, tmp_path):
    out, rejects, calls = str(tmp_path / "out"), str(tmp_path / "rejects"), tmp_path / "calls"
    calls.mkdir()
    service = Recorder(calls)
    raws = [message({"id": 1}, securities=["A", "B"]), message({"id": 2}), "{bad", message(securities=[])]
    batch = frame(spark, *raws).withColumn("ingest_ts", F.lit("2025-10-02 18:07:31").cast("timestamp"))
    run_batch(batch, out, rejects, service, batch_id=7)
    assert service.calls() == 2
    run_batch(batch, out, rejects, service, batch_id=7)
    run_batch(batch, out, rejects, service, batch_id="eight", max_object_bytes=None)
    # Rotation range-partitions the rows; that must not call the service a second time.
    run_batch(batch, out, rejects, service)
    assert service.calls() == 8
    found = sinks.read_records(spark, out).groupBy("seq").count().collect()
    assert {(r.seq, r["count"]) for r in found} == {("batch-7-000000", 3), ("batch-eight-000000", 3), ("000000", 3)}
    # Stored intermediate tables are gone.
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("run-*"))
    kept = spark.read.parquet(rejects).groupBy("reason", "batch").count().collect()
    assert {(r.reason, r.batch, r["count"]) for r in kept} == {
        (reason, b, 1) for reason in ("decode-failed", "no-securities") for b in ("7", "eight", "none")
    }
