import numpy as np
import pytest

from newsflow.llm import token_counts
from newsflow.llm.token_counts import END, TOKEN, VOCABULARY, TokenFormat, _doc_id, _encoding, _header, count_tokens, token_folder, write_token_files

from .helpers import docs, prose


@pytest.mark.parametrize("number", [None, 0, 1, -1, 2**63 - 1, -(2**63), 123456789012])
def test_header_round_trip(number):
    header = np.array(_header(number), TOKEN)
    assert _doc_id(header) == number and (header < 1 << 15).all()


def test_counts_equal_direct_tokenization(spark):
    rows = [(k, " ".join(prose(k, 1 + 37 * k % 200))) for k in range(30)]
    rows += [(100, None), (101, ""), (None, "no id"), (102, "<|endoftext|> is text"), (103, "汉字 Ā ñ"), (104, " ".join(prose(5, 5000))), (0, "again")]
    folder = token_folder(spark)
    write_token_files(docs(spark, rows).repartition(3), folder)
    encode = _encoding(VOCABULARY).encode_ordinary
    wanted = sorted((str(doc), len(encode(text or ""))) for doc, text in rows)
    # blocks of all sizes, down to less than a header, and slices of few blocks
    for block, slice_ in ((1 << 19, 1024), (50, 4), (6, 3), (3, 2)):
        got = count_tokens(spark, folder, block, slice_).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == wanted
        assert len({(r.file, r.ordinal) for r in got}) == len(rows)


def test_empty(spark):
    folder = token_folder(spark)
    write_token_files(docs(spark, []), folder)
    assert count_tokens(spark, folder).collect() == []


def test_file_without_last_separator(spark, tmp_path):
    tokens = [*_header(7), 1, 2, END, *_header(8), 3, 4, 5]
    (tmp_path / "part-0").write_bytes(np.array(tokens, TOKEN).tobytes())
    for block in (4, 100):
        assert sorted((r.ordinal, r.doc_id, r.n_tokens) for r in count_tokens(spark, str(tmp_path), block, 2).collect()) == [(0, 7, 2), (1, 8, 3)]


def plain_counts(tokens, form):
    """Tokens of each document, by a scan from front to back."""
    out, n = [], 0
    for token in tokens:
        if token == form.end:
            out.append(max(n - form.header, 0))
            n = 0
        else:
            n += 1
    return out + ([max(n - form.header, 0)] if n else [])


@pytest.mark.parametrize("form", [TokenFormat(), TokenFormat("<u4", 0, 0), TokenFormat("<u2", 50256, 2)])
def test_files_of_other_layouts_read_by_ranges(spark, tmp_path, monkeypatch, form):
    monkeypatch.setattr(token_counts, "RANGE_BLOCKS", 3)
    rng = np.random.default_rng(5)
    files = {}
    for k, n in enumerate((1, 2, 64, 999, 3000)):
        tokens = rng.integers(1, 4, n)
        tokens[rng.random(n) < (0.1, 0.001)[k % 2]] = form.end
        files[f"part-{k}.bin"] = tokens
        (tmp_path / f"part-{k}.bin").write_bytes(tokens.astype(form.token).tobytes())
    (tmp_path / "part-empty.bin").write_bytes(b"")
    (tmp_path / "other").write_bytes(b"odd")
    wanted = {name: plain_counts(tokens.tolist(), form) for name, tokens in files.items()}
    # all files whole, all by ranges, and some of each
    for whole, block in ((1 << 20, 7), (0, 7), (0, 64), (500, 1)):
        got = {}
        for r in count_tokens(spark, str(tmp_path), block, 4, form=form, whole_bytes=whole).orderBy("ordinal").collect():
            name = r.file.rsplit("/", 1)[1]
            assert r.ordinal == len(got.setdefault(name, []))
            got[name].append(r.n_tokens)
        assert got == wanted


def test_ids_and_counts_by_ranges_equal_those_of_whole_files(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RANGE_BLOCKS", 2)
    folder = token_folder(spark)
    write_token_files(docs(spark, [(k, " ".join(prose(k, 1 + 37 * k % 200))) for k in range(30)]).repartition(2), folder)
    whole = sorted(map(tuple, count_tokens(spark, folder).collect()))
    for block in (3, 6, 50):
        assert sorted(map(tuple, count_tokens(spark, folder, block, 4, whole_bytes=0).collect())) == whole


def test_a_broken_file_is_an_error(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(b"odd")
    for whole in (0, 100):
        with pytest.raises(Exception, match="whole number|multiple"):
            count_tokens(spark, str(tmp_path), whole_bytes=whole).collect()
