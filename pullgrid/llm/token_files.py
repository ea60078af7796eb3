"""Token-ID output: Arrow files of equal-length sequences with masks.

Documents are range-partitioned by ``doc_id`` and encoded by the tokenizers library;
rows without an id, or with the same one, are ranged on by their text, so any number of
them spreads over tasks and files. Each document's ids end with an end id. A partition lays its ids end to end and
writes one Arrow IPC file: ``ids`` are fixed-size lists, so every record
batch but the last holds the same number of equal-length rows, and sequence i and its
mask (a byte per position) are slices of the mapped file without a copy. The last row is
padded, its mask says where. The masks are views of a list of bytes: those of all full
rows are one and the same stretch, so they take no room for each row.
``docs`` lists the documents that end in a row, each with its end in that row. Ids are
16-bit where the vocabulary allows it.

A file gets a fresh name per task attempt, and only files in the manifest count, so a
retried or doubled task leaves an orphan at most. The manifest has one row per file;
the files' first positions are its running sum.

Defined results. Null or empty text: the end id alone. Null ``doc_id``: first in the
order. Repeated ``doc_id``: ordered by the first characters of the text, then its hash. No rows: no files, no rows. A special
token's string becomes its id, as the library does. Other columns are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.folders import scratch_dir
from pullgrid.llm.bpe import merger
from pullgrid.llm.common import partitions, table, written
from pullgrid.llm.pieces import PieceEncoder
from pullgrid.llm.ragged import gather, offsets
from pullgrid.llm.runs import in_ranges
from pullgrid.llm.slices import text_slices
from pullgrid.shipping import ship_package

SEQUENCE = 1024
BATCH_ROWS = 256
END_ID = 2
TABLE_PIECES = 250_000  # encoded pieces a worker keeps
ORDER_CHARS = 64  # of a text, to order rows of one id: whole texts would travel to the driver as range bounds


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceEncoder:
    """The tokenizers library behind a table of pieces it has encoded already."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    sizes = merger(path).lengths

    def encode_whole(text: str) -> np.ndarray:
        # one text at a time, without the offsets that are not used here
        (encoded,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, np.uint32)

    def encode_many(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces with a space before them go as one text; ids fall to pieces by their bytes."""
        spaced = [p for p in pieces if p[0] == " "]
        joined = encode_whole("".join(spaced))
        bounds = offsets(np.array([len(p.encode()) for p in spaced], np.int64))
        ends = np.cumsum(sizes[joined])
        cuts = np.searchsorted(ends, bounds, "right")
        if len(spaced) == len(pieces):
            return joined, np.diff(cuts)
        # the first pieces of texts have no space before them and stand alone
        alone = [encode_whole(p) for p in pieces if p[0] != " "]
        is_spaced = np.fromiter((p[0] == " " for p in pieces), bool, len(pieces))
        flat = np.concatenate([joined, *alone])
        sizes_alone = np.array([len(p) for p in alone], np.int64)
        lengths, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        lengths[is_spaced], starts[is_spaced] = np.diff(cuts), cuts[:-1]
        lengths[~is_spaced] = sizes_alone
        starts[~is_spaced] = len(joined) + offsets(sizes_alone)[:-1]
        return gather(flat, starts, lengths), lengths

    return PieceEncoder(encode_many, encode_whole, tuple(merger(path).special), TABLE_PIECES)


def id_type(path: str) -> pa.DataType:
    return pa.uint16() if merger(path).size <= 1 << 16 else pa.uint32()


def schema(ids: pa.DataType, sequence: int) -> pa.Schema:
    ends = pa.list_(pa.struct([("doc_id", pa.int64()), ("end", pa.int32())]))
    return pa.schema(
        [("ids", pa.list_(ids, sequence)), ("mask", pa.list_view(pa.uint8())), ("docs", ends)]
    )


class SequenceWriter:
    """Lays ids end to end and writes them as batches of equal-length rows."""

    def __init__(self, sink, ids: pa.DataType, sequence: int, batch_rows: int):
        self.type, self.sequence, self.rows = ids, sequence, batch_rows
        self.schema = schema(ids, sequence)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.doc_ids, self.ends = [], [], []
        self.held, self.written, self.ended = 0, 0, 0

    def add(self, ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None]) -> None:
        self.ids.append(ids)
        self.doc_ids += doc_ids
        self.ends.append(self.ended + np.cumsum(lengths))
        self.ended += len(ids)
        self.held += len(ids)
        while self.held >= self.rows * self.sequence:
            self._flush(self.rows * self.sequence)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.ids)
        out, rest = flat[:n], flat[n:]
        self.ids, self.held = [rest], len(rest)
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0, np.int64)
        here = int(np.searchsorted(ends, self.written + n, "right"))
        rows = -(-n // self.sequence)
        padded = np.zeros(rows * self.sequence, self.type.to_pandas_dtype())
        padded[:n] = out
        # a full row's mask, and from its middle on that of a row that is full up to somewhere
        filled = n - (rows - 1) * self.sequence
        masks = np.repeat(np.array([1, 0], np.uint8), self.sequence)
        first = np.zeros(rows, np.int32)
        first[-1] = self.sequence - filled
        local = ends[:here] - self.written
        row = np.maximum(local - 1, 0) // self.sequence
        docs = pa.StructArray.from_arrays(
            [
                pa.array(self.doc_ids[:here], pa.int64()),
                pa.array((local - row * self.sequence).astype(np.int32)),
            ],
            ["doc_id", "end"],
        )
        starts = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
        self.writer.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(padded), self.sequence),
                    pa.ListViewArray.from_arrays(
                        pa.array(first), pa.array(np.full(rows, self.sequence, np.int32)), pa.array(masks)
                    ),
                    pa.ListArray.from_arrays(pa.array(starts), docs),
                ],
                schema=self.schema,
            )
        )
        self.doc_ids = self.doc_ids[here:]
        self.ends = [ends[here:]]
        self.written += n

    def close(self) -> int:
        if self.held:
            self._flush(self.held)
        self.writer.close()
        return self.ended


def write_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Write the files; (part, path, n_tokens, start) of each, in the order of ``doc_id``."""
    ship_package(docs.sparkSession)
    keys = [F.col("doc_id"), F.substring("text", 1, ORDER_CHARS), F.xxhash64("text")]
    ordered = in_ranges(docs.select("doc_id", "text"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = library_encoder(tokenizer), TaskContext.get().partitionId()
        writer = sink = None
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in text_slices(batches):
            if writer is None:
                files, place = pafs.FileSystem.from_uri(path)
                files.create_dir(place.rpartition("/")[0])
                sink = files.open_output_stream(place)
                writer = SequenceWriter(sink, id_type(tokenizer), sequence, batch_rows)
            ids, counts = encode(batch.column("text"))
            ends = offsets(counts)[1:] + np.arange(len(counts))
            all_ids = np.full(len(ids) + len(counts), end_id, np.uint32)
            inner = np.ones(len(all_ids), bool)
            inner[ends] = False
            all_ids[inner] = ids
            writer.add(all_ids, counts + 1, batch.column("doc_id").to_pylist())
        if writer is not None:
            total = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [path], "n_tokens": [total]}
            )

    files = written(ordered.mapInArrow(run, "part int, path string, n_tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    files, place = pafs.FileSystem.from_uri(path)
    if isinstance(files, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(place))
    return pa.ipc.open_file(files.open_input_file(place))


def sequence_at(reader: pa.ipc.RecordBatchFileReader, i: int, batch_rows: int = BATCH_ROWS):
    """(ids, mask) of sequence i, both views of the file; the mask is 1 where ids are."""
    batch = reader.get_batch(i // batch_rows)
    n, row = batch.schema.field("ids").type.list_size, i % batch_rows
    masks = batch.column("mask")
    first = masks.offsets[row].as_py()
    return batch.column("ids").values.to_numpy()[row * n : (row + 1) * n], masks.values.to_numpy()[first : first + n]


def documents_of(path: str) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """(doc ids, their ids) of a file, batch by batch."""
    reader = open_file(path)
    held = np.zeros(0, np.uint32)
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        width = batch.schema.field("ids").type.list_size
        masks, last = batch.column("mask"), batch.num_rows - 1
        first = masks.offsets[last].as_py()
        # only the last row may be padded
        filled = int(masks.values.to_numpy()[first : first + width].sum())
        ids = batch.column("ids").values.to_numpy()[: last * width + filled]
        docs = batch.column("docs")
        row = np.repeat(np.arange(len(docs)), np.diff(docs.offsets.to_numpy()))
        ends = docs.values.field("end").to_numpy(zero_copy_only=False) + row * width + len(held)
        flat = np.concatenate([held, ids.astype(np.uint32)])
        cuts = np.concatenate([[0], ends]).astype(np.int64)
        yield (
            docs.values.field("doc_id").to_pylist(),
            [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        )
        held = flat[cuts[-1] :]


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                start = file["start"]
                for doc_ids, texts in documents_of(file["path"]):
                    sizes = np.array([len(t) for t in texts], np.int64)
                    starts = start + offsets(sizes)
                    start = int(starts[-1])
                    crc = [zlib.crc32(t.astype("<u4").tobytes()) for t in texts]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(starts[:-1]),
                            pa.array(sizes),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    n = partitions(manifest.sparkSession)
    return manifest.repartitionByRange(n, "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "tokens")
    return read_files(write_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder))
