from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from pullgrid.folders import scratch_dir
from pullgrid.llm import token_files


def expected(tokenizer, rows):
    library, out, start = Tokenizer.from_file(tokenizer), [], 0
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    for doc, text, *_ in sorted(rows, key=order):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


def test_odd_rows_come_back_from_the_files(spark, odd, odd_rows, tokenizer):
    folder = scratch_dir(spark, "tokens")
    files = token_files.write_files(odd, tokenizer, folder, sequence=16, batch_rows=3)
    assert Counter(tuple(r) for r in token_files.read_files(files).collect()) == expected(
        tokenizer, odd_rows
    )
    for file in files.collect():
        reader = token_files.open_file(file.path)
        total = sum(reader.get_batch(k).num_rows for k in range(reader.num_record_batches))
        assert all(reader.get_batch(k).num_rows == 3 for k in range(reader.num_record_batches - 1))
        flat = [token_files.sequence_at(reader, i, 3) for i in range(total)]
        assert sum(int(m.sum()) for _, m in flat) == file.n_tokens
        assert all(m.all() for _, m in flat[:-1])


def test_a_sequence_is_a_view_of_the_mapped_file(spark, tokenizer):
    df = spark.createDataFrame([(1, "the cat sat on the mat")], "doc_id long, text string")
    (file,) = token_files.write_files(df, tokenizer, scratch_dir(spark, "tokens"), sequence=4).collect()
    reader = token_files.open_file(file.path)
    before = pa.total_allocated_bytes()
    ids, mask = token_files.sequence_at(reader, 0)
    assert not ids.flags.owndata and pa.total_allocated_bytes() - before < 256
    assert not mask.flags.owndata and mask.tolist() == [1, 1, 1, 1]


def test_rows_without_an_id_spread_over_the_files(spark, tokenizer):
    """A third has no id, half of them with equal texts; a third repeats one id."""
    rows = [(None, f"text {k}" if k % 2 else "equal text") for k in range(400)]
    rows += [(7, f"other text {k}") for k in range(400)] + [(100 + k, f"own {k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    files = token_files.write_files(df, tokenizer, scratch_dir(spark, "tokens")).collect()
    held = [
        sum(len(ids) for ids, _ in token_files.documents_of(f.path)) for f in sorted(files, key=lambda f: f.part)
    ]
    assert sum(held) == len(rows) and max(held) < 2 * len(rows) / len(held) + 100
    manifest = token_files.write_files(df, tokenizer, scratch_dir(spark, "tokens"))
    got = sorted(tuple(r) for r in token_files.read_files(manifest).select("start", "n_tokens", "doc_id").collect())
    assert [start for start, *_ in got] == [sum(n for _, n, _ in got[:k]) for k in range(len(got))]
    order = [doc for *_, doc in got]
    assert order == sorted(order, key=lambda d: -1 if d is None else d)


def test_nothing(spark, nothing, tokenizer):
    files = token_files.write_files(nothing, tokenizer, scratch_dir(spark, "tokens"))
    assert token_files.read_files(files).count() == 0


def test_masks_of_full_rows_take_no_room(spark, tokenizer):
    df = spark.createDataFrame([(1, "the cat sat on the mat " * 20_000)], "doc_id long, text string")
    (file,) = token_files.write_files(df, tokenizer, scratch_dir(spark, "tokens")).collect()
    reader = token_files.open_file(file.path)
    size = token_files.pafs.FileSystem.from_uri(file.path)
    width = token_files.id_type(tokenizer).bit_width // 8
    assert file.n_tokens > 100_000
    assert size[0].get_file_info(size[1]).size < (width + 0.1) * file.n_tokens
    masks = [token_files.sequence_at(reader, i)[1] for i in range(-(-file.n_tokens // 1024))]
    assert [len(m) for m in masks] == [1024] * len(masks)
    assert all(m.all() for m in masks[:-1]) and sum(int(m.sum()) for m in masks) == file.n_tokens


def test_pieces_are_told_apart_once_per_slice(tokenizer):
    """The table of pieces was asked for every word; odd and empty texts stand between the others."""
    from pullgrid.llm.pieces import PieceEncoder
    from pullgrid.llm.token_files import library_encoder

    library, asked = library_encoder(tokenizer), []

    class Table(dict):
        def get(self, piece, default=None):
            asked.append(piece)
            return super().get(piece, default)

    encoder = PieceEncoder(library.encode_many, library.encode_whole, library.special)
    encoder.codes = Table()
    texts = ["one two one two " * 50 + "end", None, "", " lead", "a  b", "tab\tx one", "nul\0l two", "é\nü one", "two"]
    ids, counts = encoder(texts)
    assert len(asked) == len(set(asked)) < 30
    expected = [library.encode_whole(t).tolist() if t else [] for t in texts]
    ends = counts.cumsum()
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == expected
