from contextlib import contextmanager

from newsflow.sources import bad_lines, number_lines, parse_lines, read_archive


@contextmanager
def split_at(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def write(folder, texts):
    for name, lines in texts.items():
        (folder / name).write_text("\n".join(lines) + "\n")


def sample():
    a = ["" if k % 7 == 0 else "{bad" if k % 11 == 3 else f'{{"n":{k}}}' for k in range(3000)]
    b = ['{"x": "' + "y" * (k % 50 * 40) + '"}' if k % 13 else "no json é" for k in range(400)]
    return {"a.ndjson": a, "b.ndjson": b, "c.ndjson": ["{bad"], "d.ndjson": ["", "  ", "{bad", ""]}


def test_numbers_over_files_of_several_splits(spark, tmp_path):
    texts = sample()
    write(tmp_path, texts)
    with split_at(spark, 4096):
        lines = read_archive(spark, str(tmp_path))
        assert lines.select("path", "block").distinct().count() > 10
        got = {(r.path.rsplit("/", 1)[1], r.line_number, r.line) for r in number_lines(lines).collect()}
        wanted = {(name, k, line) for name, rows in texts.items() for k, line in enumerate(rows, 1)}
        assert got == wanted
        bad = bad_lines(parse_lines(number_lines(lines)))
        found = {(r.path.rsplit("/", 1)[1], r.line_number) for r in bad.collect()}
        assert found == {(n, k) for n, k, line in wanted if line.strip() and not line.startswith(('{"n"', '{"x"'))}


def test_no_files_with_lines(spark, tmp_path):
    (tmp_path / "empty.ndjson").write_text("")
    assert number_lines(read_archive(spark, str(tmp_path))).collect() == []
