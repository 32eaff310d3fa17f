"""Records and rejects from one parse, and in one commit."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsflow.operators import ingest, objects, sinks
from newsflow.operators.objects import read_objects, read_rejects
from newsflow.plans.pipeline import route_messages, run_batch
from newsflow.sources import stream_messages
from newsflow.streaming.job import start

from .messages import frame, message
from .test_enrich import Recorder
from .test_objects import hidden, names

RAWS = [
    message({"id": 1}, securities=["A", "B"]),
    "{bad",
    message({"id": 2}, title="line separator   inside"),
    message({"id": 3}, securities=[]),
    "5",
    message({"id": "no number"}),
    message({"id": 4}, body=""),
]
REASONS = {"decode-failed": 1, "validation-failed": 2, "no-securities": 1}


def reasons(rejects):
    return {r.reason: r.n for r in rejects.groupBy("reason").agg(F.count("*").alias("n")).collect()}


def counted(spark, path, raws):
    """Messages whose raw text counts how often it is read."""
    reads = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    return frame(spark, *raws).mapInArrow(touch, "key int, raw string"), reads


@pytest.mark.parametrize("options", [{"max_object_bytes": 500}, {"writer": "host"}])
@pytest.mark.parametrize("called", [False, True])
def test_each_message_is_read_once_for_both_outputs(spark, tmp_path, options, called):
    (tmp_path / "calls").mkdir()
    service = Recorder(tmp_path / "calls") if called else None
    messages, reads = counted(spark, tmp_path, RAWS)
    out, no = str(tmp_path / "out"), str(tmp_path / "no")
    run_batch(messages, out, no, service, **options)
    assert reads.value == len(RAWS)
    found = read_objects(spark, out) if "writer" in options else sinks.read_records(spark, out)
    assert sorted((r.news_id, r.ticker) for r in found.collect()) == [(1, "A"), (1, "B"), (2, "LHBK"), (4, "LHBK")]
    assert reasons(spark.read.parquet(no)) == REASONS
    # Neither rejects nor blank bodies are sent to the service.
    assert service is None or service.calls() == 2


def test_routes_equal_the_separate_branches(spark):
    parsed = ingest.parse_messages(frame(spark, *RAWS))
    rows, rejects = route_messages(parsed, keep=("key",))
    wanted = ingest.quarantine(parsed)
    both = rejects.select("raw", "reason", "errors")
    assert both.exceptAll(wanted).isEmpty() and wanted.exceptAll(both).isEmpty() and both.count() == 4
    assert {r.key for r in rejects.collect()} == {1, 3, 4, 5} and {r.key for r in rows.collect()} == {0, 2, 6}


def test_a_prompt_of_the_callers_own_may_use_any_column(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    service = Recorder(tmp_path / "calls")
    run_batch(frame(spark, *RAWS), str(tmp_path / "out"), None, service, writer="host", text=F.concat(F.col("kind"), F.lit(" "), F.col("raw")))
    assert service.calls() == 3 and read_objects(spark, str(tmp_path / "out")).count() == 4


def test_records_and_rejects_commit_together(spark, tmp_path):
    out = str(tmp_path)
    run_batch(frame(spark, *RAWS), out, writer="host", batch_id="a", max_object_bytes=300)
    assert read_objects(spark, out).count() == 4 and reasons(read_rejects(spark, out)) == REASONS
    errors = {r.reason: r.errors for r in read_rejects(spark, out).where("raw <> '5'").collect()}
    assert [e.field for e in errors["validation-failed"]] == ["data.id"] and errors["decode-failed"] is None
    assert sorted(r.raw for r in read_rejects(spark, out).collect()) == sorted(RAWS[k] for k in (1, 3, 4, 5))
    note = json.loads((tmp_path / "_manifests" / "a.json").read_text())
    assert sorted(f for f, _ in note["files"]) == names(tmp_path) and any(f.startswith("_quarantine/") for f, _ in note["files"])
    # The same run again, with other messages, replaces both.
    run_batch(frame(spark, RAWS[0], RAWS[1]), out, writer="host", batch_id="a", max_object_bytes=300)
    assert read_objects(spark, out).count() == 2 and reasons(read_rejects(spark, out)) == {"decode-failed": 1} and not hidden(tmp_path)


def test_only_rejects_only_records_and_nothing(spark, tmp_path):
    run_batch(frame(spark, "{bad", "{bad"), str(tmp_path / "bad"), writer="host")
    assert reasons(read_rejects(spark, str(tmp_path / "bad"))) == {"decode-failed": 2}
    run_batch(frame(spark, RAWS[0]), str(tmp_path / "good"), writer="host")
    assert not (tmp_path / "good" / "_quarantine").exists() and read_objects(spark, str(tmp_path / "good")).count() == 2
    run_batch(frame(spark, RAWS[0]).where("false"), str(tmp_path / "none"), writer="host")
    assert names(tmp_path / "none") == []
    with pytest.raises(ValueError, match="rejects"):
        run_batch(frame(spark, *RAWS), str(tmp_path / "x"))


@pytest.mark.parametrize("broken", ["_quarantine", "ingest_dt"])
def test_a_failure_in_either_leaves_neither(spark, tmp_path, broken):
    writes = objects.ObjectWriter.write

    class Failing(objects.ObjectWriter):
        def write(self, iterator):
            done = writes(self, iterator)
            if any(f[0].startswith(broken) for f in done.files):
                raise OSError("no space")
            return done

    class Broken(objects.ObjectFiles):
        def writer(self, schema, overwrite):
            return Failing(dict(self.options))

    original, objects.ObjectFiles = objects.ObjectFiles, Broken
    try:
        with pytest.raises(Exception, match="no space"):
            run_batch(frame(spark, *RAWS), str(tmp_path), writer="host")
    finally:
        objects.ObjectFiles = original
    assert names(tmp_path) == [] and not hidden(tmp_path)


def test_stream_commits_both_and_fills_reject_files(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for k in range(4):
        (landing / f"{k}.json").write_text("\n".join([message({"id": k}), *(f"{{bad {k} {j}" for j in range(5))]) + "\n")
    query = start(stream_messages(spark, str(landing), 1), out, None, str(tmp_path / "state"), available_now=True, writer="live", max_object_bytes=500)
    query.awaitTermination()
    assert read_objects(spark, out).count() == 4 and reasons(read_rejects(spark, out)) == {"decode-failed": 20}
    sizes = {}
    for name in names(tmp_path / "out"):
        if name.startswith("_quarantine"):
            sizes.setdefault(Path(name).name[:15], []).append((tmp_path / "out" / name).stat().st_size)
    # Reject files go on over the batches like those of the records: all but the last are full.
    assert all(sum(sizes[f]) >= 500 for f in sorted(sizes)[:-1]) and any(len(s) > 1 for s in sizes.values())
