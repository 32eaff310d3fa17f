import json
from pathlib import Path

from pyspark.sql import functions as F

from newsflow.functions import times
from newsflow.operators import archive, monitor
from newsflow.sources import bad_lines, list_archive, parse_lines, read_archive

from .test_enrich import Recorder

ISO = "2025-10-02T18:00:00Z"
LINES = [
    ('{"timestamp":"2025-10-02T18:00:00Z","x":1}', '{"timestamp":1759428000000,"x":1}'),
    ('{"timestamp":1759428000000,"x":1}', None),
    ('{"x":1}', None),
    ('{"timestamp":"2025-10-02T23:00:00+05:00"}', '{"timestamp":1759428000000}'),
    ('{"timestamp":"2025-10-02 18:00:00"}', '{"timestamp":1759428000000}'),
    ('{"timestamp":"2025-10-02T18:00:00.123456Z"}', '{"timestamp":1759428000123}'),
    ('{"timestamp":"20251002T180000Z"}', '{"timestamp":1759428000000}'),
    ('{"timestamp":"2025-W40-4"}', '{"timestamp":1759363200000}'),
    ('{"timestamp":"2025-10-02T18:00:00+20:00"}', '{"timestamp":1759356000000}'),
    ('{"timestamp":"nope"}', None),
    ('{"timestamp":""}', None),
    ("{bad", None),
    ("5", None),
    ('"timestamp"', None),
    ('["timestamp"]', None),
    ('[{"timestamp":"2025-10-02T18:00:00Z"}]', None),
    ('{"timestamp":"2025-10-02T18:00:00Z"} x', None),
    ('{"meta":{"timestamp":"2025-10-02T18:00:00Z"}}', None),
    (
        '{"meta":{"timestamp":"2025-10-02T18:00:00Z"}, "timestamp" : "2025-10-02T18:00:00Z" ,"b":"é"}',
        '{"meta":{"timestamp":"2025-10-02T18:00:00Z"}, "timestamp" : 1759428000000 ,"b":"é"}',
    ),
    ('{"time\\u0073tamp":"2025-10-02T18:00:00Z"}', '{"time\\u0073tamp":1759428000000}'),
    ('{"timestamp":"2025-10-02T18\\u003a00:00Z"}', '{"timestamp":1759428000000}'),
    ('{"x\\"timestamp":"2025-10-02T18:00:00Z"}', None),
    (
        '{"note":"\\"timestamp\\":\\"2025-10-02T18:00:00Z\\"","timestamp":"2025-10-02T18:00:00Z"}',
        '{"note":"\\"timestamp\\":\\"2025-10-02T18:00:00Z\\"","timestamp":1759428000000}',
    ),
    ('{"timestamp":null,"z":"$1 \\\\ ${key}"}', None),
    ('{"timestamp":"2025-10-02T18:00:00Z","z":"$1 \\\\ ${key}"}', '{"timestamp":1759428000000,"z":"$1 \\\\ ${key}"}'),
    ("", None),
]


def rewritten(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, line string").coalesce(1)
    return [r.line for r in archive.rewrite_lines(df).orderBy("i").collect()]


def test_rewrite_and_idempotence(spark):
    found = rewritten(spark, [line for line, _ in LINES])
    assert found == [line if new is None else new for line, new in LINES]
    assert rewritten(spark, found) == found


def write(path: Path, text: str):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def rewritten_files(spark, source, target):
    """Source file name to its lines: the part files of its folder in order of their names."""
    found = {}
    for key in archive.file_keys(spark, str(source)).collect():
        parts = sorted((Path(target) / f"file={key.file}").glob("part-*.txt"))
        lines = [line for part in parts for line in part.read_bytes().decode().split("\n")[:-1]]
        if parts:
            found[key.path.rsplit("/", 1)[1]] = lines
    return found


def test_file_rewrite_keeps_files_and_order_over_splits(spark, tmp_path):
    many = [f'{{"n":{i},"timestamp":"2025-10-02T18:00:00Z"}}' for i in range(3000)]
    deep = tmp_path / "in" / "/".join(["a folder with a rather long name"] * 9)
    assert len(str(deep)) > 300
    write(tmp_path / "in/a.ndjson", "\n".join(many) + "\n")
    write(tmp_path / "in/second.txt", "\n".join(many[::-1]) + "\n")
    write(deep / "b.ndjson", '\n \n{"timestamp":"2025-10-02T18:00:00Z"}\n\n{bad\r\n\n\n')
    write(tmp_path / "in/blank.ndjson", "\n \n")
    write(tmp_path / "in/other.json", '{"timestamp":"2025-10-02T18:00:00Z"}\n')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        archive.rewrite_archive(spark, str(tmp_path / "in"), str(tmp_path / "out"))
        archive.rewrite_archive(spark, str(tmp_path / "in"), str(tmp_path / "trimmed"), trim_files=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(list((tmp_path / "out").glob("file=*"))) == 4
    assert max(len(list(p.glob("part-*"))) for p in (tmp_path / "out").glob("file=*")) > 3
    plain, trimmed = (rewritten_files(spark, tmp_path / "in", tmp_path / t) for t in ("out", "trimmed"))
    assert set(plain) == set(trimmed) == {"a.ndjson", "b.ndjson", "blank.ndjson", "second.txt"}
    assert plain["a.ndjson"] == trimmed["a.ndjson"] == [line.replace(f'"{ISO}"', "1759428000000") for line in many]
    assert plain["second.txt"] == trimmed["second.txt"] == plain["a.ndjson"][::-1]
    assert plain["b.ndjson"] == ["", " ", '{"timestamp":1759428000000}', "", "{bad\r", "", ""]
    assert trimmed["b.ndjson"] == ['{"timestamp":1759428000000}', "", "{bad\r"]
    assert plain["blank.ndjson"] == trimmed["blank.ndjson"] == ["", " "]
    # What was written can be read as an archive again.
    assert read_archive(spark, str(tmp_path / "out")).count() == 6009
    # The source is untouched.
    assert ISO in (tmp_path / "in/a.ndjson").read_text()


def test_python_reads_times_like_spark(spark):
    texts = ["2025-10-02T18:00:00.123456Z", "1969-12-31T23:59:59.9999+00:00", "2025-10-02 18:00:00.1", "0001-01-02T00:00:00Z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", times.epoch_millis(archive._utc(F.col("t")).cast("timestamp")).alias("ms"))
    assert [archive.iso_to_millis(r.t) for r in rows.collect()] == [r.ms for r in rows.collect()]


def test_long_line_is_still_rewritten(spark):
    line = json.dumps({"timestamp": ISO, "body": "x" * 21_000_000})
    assert rewritten(spark, [line])[0].startswith('{"timestamp": 1759428000000')


def test_listing_and_lenient_read(spark, tmp_path):
    write(tmp_path / "b.ndjson", '{"a":1}\n\n  {"a":2}  \n{bad\n')
    write(tmp_path / "a.ndjson", "[1]\n")
    write(tmp_path / "c.json", "{}\n")
    paths = [r.path for r in list_archive(spark, str(tmp_path)).collect()]
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.ndjson", "b.ndjson"]
    lines = parse_lines(read_archive(spark, str(tmp_path)))
    bad = bad_lines(lines).collect()
    assert lines.count() == 4 and [(r.line, r.path.rsplit("/", 1)[1]) for r in bad] == [("{bad", "b.ndjson")]


def test_backfill_and_stats(spark):
    good = {"news_id": 1, "timestamp": ISO, "ticker": " TSLA ", "title": "T", "body": "<p>short</p>"}
    values = [
        json.dumps(good),
        json.dumps({**good, "body": "word " * 60, "timestamp": 1759428000000}),
        json.dumps({**good, "ticker": " "}),
        json.dumps({**good, "news_id": None}),
        json.dumps({**good, "timestamp": "soon"}),
        json.dumps({**good, "title": 5}),
        "{bad",
        "  ",
    ]
    lines = spark.createDataFrame([(f"f{i % 2}", v) for i, v in enumerate(values)], "path string, line string")
    rows = archive.backfill(lines).collect()
    assert sorted((r.ticker, r.timestamp, r.content[:5]) for r in rows) == [
        ("TSLA", 1759428000000, "short"),
        ("TSLA", 1759428000000, "word "),
    ]
    failures = archive.migration_failures(archive.read_legacy(lines))
    assert monitor.migration_stats(archive.migrate(lines), failures).first()[:] == (2, 7, 2, 5, 1, 1)
    assert sorted((r.path, r.reason) for r in failures.collect()) == [
        ("f0", "decode-failed"), ("f0", "missing-ticker"), ("f0", "wrong-type"), ("f1", "missing-news_id"), ("f1", "wrong-type"),
    ]


def test_backfill_with_a_service_counts_its_answers(spark, tmp_path):
    good = {"news_id": 1, "timestamp": ISO, "ticker": "A", "title": "T", "body": "<p>some <b>text</b></p>"}
    values = [json.dumps({**good, "news_id": k, "body": None if k == 3 else good["body"]}) for k in range(4)] + ["{bad"]
    lines = spark.createDataFrame([("f", v) for v in values], "path string, line string")
    failures = archive.migration_failures(archive.read_legacy(lines))
    for html, sent in ((False, "Article:"), (True, "HTML Content:")):
        folder = tmp_path / str(html)
        folder.mkdir()
        service = Recorder(folder)
        done = archive.migrate(lines, service, html=html)
        assert monitor.migration_stats(done, failures).first()[:] == (1, 5, 4, 1, 3, 1)
        calls = [p.read_text() for p in folder.iterdir()]
        assert len(calls) == 3 and all(sent in c and ("<b>" in c) == html for c in calls)
    rows = archive.backfill(lines, Recorder(tmp_path / "True"), html=True).collect()
    assert sorted(r.content for r in rows)[0] == "T" and sum(r.content.startswith("summary of") for r in rows) == 3
