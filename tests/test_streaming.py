from newsflow.operators import sinks
from newsflow.plans.pipeline import run_batch
from newsflow.sources import read_messages, stream_messages
from newsflow.streaming.job import start

from .messages import message
from .test_enrich import Recorder

RAWS = [
    message({"id": 1}, securities=["A", "B"]),
    "{bad",
    message({"id": 2}, title="line separator"),
    message(securities=[]),
    "5",
    message({"id": 3}),
]


def land(folder, name, raws):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(raws) + "\n")


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    landing, calls = tmp_path / "landing", tmp_path / "calls"
    calls.mkdir()
    out, rejects, state = str(tmp_path / "out"), str(tmp_path / "rejects"), str(tmp_path / "state")
    service = Recorder(calls)

    def run():
        query = start(stream_messages(spark, str(landing), 1), out, rejects, state, service, available_now=True)
        query.awaitTermination()

    land(landing, "1.json", RAWS[:3])
    land(landing, "2.json", RAWS[3:5])
    run()
    land(landing, "3.json", RAWS[5:])
    run()
    run()
    assert service.calls() == 3

    expected, kept = str(tmp_path / "batch-out"), str(tmp_path / "batch-rejects")
    run_batch(read_messages(spark, str(landing)), expected, kept, service)
    columns = [c for c in sinks.read_records(spark, out).columns if c not in sinks.LEVELS]
    live, batch = (sinks.read_records(spark, p).select(columns) for p in (out, expected))
    assert live.count() == 4 and live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()
    live_kept, batch_kept = (spark.read.parquet(p).select("raw", "reason") for p in (rejects, kept))
    assert live_kept.count() == 3 and live_kept.exceptAll(batch_kept).isEmpty()


def test_stream_rotates_by_size(spark, tmp_path):
    landing = tmp_path / "landing"
    out = str(tmp_path / "out")
    land(landing, "1.json", [message({"id": i}) for i in range(20)])
    query = start(stream_messages(spark, str(landing)), out, str(tmp_path / "no"), str(tmp_path / "state"), available_now=True, max_object_bytes=1000)
    query.awaitTermination()
    found = sinks.read_records(spark, out)
    assert found.count() == 20 and found.select("seq").distinct().count() > 3


def test_replayed_batch_replaces_its_output(spark, tmp_path):
    landing = tmp_path / "landing"
    out, rejects, state = str(tmp_path / "out"), str(tmp_path / "rejects"), tmp_path / "state"
    land(landing, "1.json", RAWS)

    def run():
        query = start(stream_messages(spark, str(landing)), out, rejects, str(state), available_now=True)
        query.awaitTermination()

    run()
    paths = sinks.read_records(spark, out).select("part", "seq").distinct().collect()
    # As after a crash between the write and the commit.
    for name in ("0", ".0.crc"):
        (state / "commits" / name).unlink()
    run()
    assert sinks.read_records(spark, out).count() == 4
    assert sinks.read_records(spark, out).select("part", "seq").distinct().collect() == paths
    assert spark.read.parquet(rejects).count() == 3
