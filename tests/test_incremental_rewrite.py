import json
import os
from pathlib import Path

from newsflow.operators.archive import manifest, rewrite_changed
from newsflow.sources import read_archive

from .test_line_numbers import split_at

ISO, MILLIS = "2025-10-02T18:00:00Z", 1759428000000


def lines(n, start=0, size=0):
    return [f'{{"timestamp":"{ISO}","n":{start + k},"x":"{"y" * size}"}}' for k in range(n)]


def put(path, rows, when=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(rows) + "\n")
    if when:
        os.utime(path, (when, when))


def tree(root):
    return {str(p.relative_to(root)): p for p in Path(root).rglob("*.ndjson") if not any(part.startswith("_") for part in p.relative_to(root).parts)}


def states(found):
    return {r.key: r.state for r in found.collect()}


def test_second_run_rewrites_nothing(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source / "2025/10/a b+ü.ndjson", lines(5))
    put(source / "2025/11/c.ndjson", lines(3, 10))
    put(source / "d.ndjson", ["{bad", "", '{"timestamp":1}'])
    assert manifest(spark, str(target)) is None
    assert states(rewrite_changed(spark, str(source), str(target))) == dict.fromkeys(["2025/10/a b+ü.ndjson", "2025/11/c.ndjson", "d.ndjson"], "rewritten")
    assert set(tree(target)) == set(tree(source))
    assert (target / "2025/10/a b+ü.ndjson").read_text() == (source / "2025/10/a b+ü.ndjson").read_text().replace(f'"{ISO}"', str(MILLIS))
    assert (target / "d.ndjson").read_text() == (source / "d.ndjson").read_text()
    before = {k: p.stat().st_mtime_ns for k, p in tree(target).items()}
    assert set(states(rewrite_changed(spark, str(source), str(target))).values()) == {"unchanged"}
    assert {k: p.stat().st_mtime_ns for k, p in tree(target).items()} == before

    put(source / "2025/11/c.ndjson", lines(4, 20), when=2_000_000_000)
    put(source / "new.ndjson", lines(1))
    (source / "d.ndjson").unlink()
    wanted = {"2025/10/a b+ü.ndjson": "unchanged", "2025/11/c.ndjson": "rewritten", "new.ndjson": "rewritten", "d.ndjson": "gone"}
    assert states(rewrite_changed(spark, str(source), str(target))) == wanted
    changed = {k for k, p in tree(target).items() if before.get(k) != p.stat().st_mtime_ns}
    assert changed == {"2025/11/c.ndjson", "new.ndjson"}
    assert [json.loads(x)["n"] for x in (target / "2025/11/c.ndjson").read_text().splitlines()] == [20, 21, 22, 23]
    # A file that comes back is new.
    put(source / "d.ndjson", lines(1))
    assert states(rewrite_changed(spark, str(source), str(target)))["d.ndjson"] == "rewritten"


def test_files_of_several_splits(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source / "a.ndjson", lines(300, size=50))
    put(source / "b.ndjson", lines(2))
    with split_at(spark, 4096):
        rewrite_changed(spark, str(source), str(target))
        parts = sorted(k for k in tree(target) if k.startswith("a.at-"))
        assert len(parts) > 3 and set(tree(target)) == {*parts, "b.ndjson"}
        text = "".join((target / p).read_text() for p in parts)
        assert text == (source / "a.ndjson").read_text().replace(f'"{ISO}"', str(MILLIS))
        assert read_archive(spark, str(target)).count() == 302
    # One split now: the parts of the earlier form go.
    put(source / "a.ndjson", lines(3))
    rewrite_changed(spark, str(source), str(target))
    assert set(tree(target)) == {"a.ndjson", "b.ndjson"}


def test_a_run_that_stops_before_its_manifest_is_repeated(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source / "a.ndjson", lines(3))
    rewrite_changed(spark, str(source), str(target))
    (target / "_manifest" / "v=1" / "_SUCCESS").unlink()
    assert states(rewrite_changed(spark, str(source), str(target))) == {"a.ndjson": "rewritten"}
    assert set(tree(target)) == {"a.ndjson"}
