"""The body cache as tasks of the data source see it: lookups by bucket, appends as plain files."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileType

from pullgrid.operators.body_store import LOOSE, MANIFESTS, numbers, parse_generation
from pullgrid.sources.storage import open_dir

_ROWS = pa.schema(
    [
        ("id", pa.int64()),
        ("version", pa.string()),
        ("body", pa.string()),
        ("fetched_ms", pa.int64()),
        ("status", pa.int32()),
        ("reason", pa.string()),
        ("listed", pa.string()),
    ]
)
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")
Key = tuple[int, str]


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket Spark gives to 64-bit numbers: its 32-bit hash, both halves in turn, seed 42."""
    rotate = lambda x, n: (x << np.uint32(n)) | (x >> np.uint32(32 - n))
    whole = np.ascontiguousarray(ids, np.int64).view(np.uint64)
    h = np.full(len(whole), 42, np.uint32)
    for part in (whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)):
        k = rotate(part.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rotate(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64) % buckets


class CachedBodies:
    """The cache as it is when a task starts: one generation, and the plain files beside it."""

    def __init__(self, cache_dir: str):
        self.fs, self.root = open_dir(cache_dir)
        self._buckets: list[tuple[int, dict[int, list[str]]]] = []
        done: set[str] = set()
        generation = self._newest()
        if generation is not None:
            done = set(generation.absorbed)
            for folder in generation.folders:
                by_bucket: dict[int, list[str]] = {}
                for path in self._files(folder.name):
                    number = _BUCKET.search(path.rpartition("/")[2])
                    by_bucket.setdefault(int(number[1]), []).append(path)
                self._buckets.append((folder.buckets, by_bucket))
        self._loose = [p for p in self._files(LOOSE) if p.rpartition("/")[2] not in done]

    def _files(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return [
            f.path
            for f in found
            if f.type == FileType.File and not f.base_name.startswith((".", "_"))
        ]

    def _newest(self):
        names = [p.rpartition("/")[2] for p in self._files(MANIFESTS)]
        for number in numbers(names):
            with self.fs.open_input_stream(f"{self.root}/{MANIFESTS}/{number}.json") as source:
                found = parse_generation(self.root, number, source.read().decode())
            if found is not None:
                return found
        return None

    def files_for(self, ids: np.ndarray) -> list[str]:
        """The files that may hold some ids: of each folder their buckets, and all plain ones."""
        files = list(self._loose)
        for buckets, by_bucket in self._buckets:
            for number in np.unique(bucket_of(ids, buckets)):
                files += by_bucket.get(int(number), [])
        return files

    def find(self, wanted: list[Key]) -> dict[Key, str]:
        """Bodies of the (id, version) that are held: of the same version first, then the newest."""
        ids = np.unique(np.array([i for i, _ in wanted], np.int64))
        files = self.files_for(ids)
        if not files:
            return {}
        data = ds.dataset(files, schema=_ROWS, filesystem=self.fs, format="parquet")
        table = data.to_table(
            columns=["id", "version", "listed", "body", "fetched_ms"],
            filter=pc.field("id").isin(pa.array(ids)) & pc.field("reason").is_null(),
            use_threads=False,
        )
        best: dict[Key, tuple[bool, int, str]] = {}
        for row in table.to_pylist():
            for version in {row["version"], row["listed"] or row["version"]}:
                key, value = (row["id"], version), (version == row["version"], row["fetched_ms"], row["body"])
                if key not in best or best[key] < value:
                    best[key] = value
        return {key: body for key, (_, _, body) in best.items()}

    def keep(self, outcome: str, rows: list[dict]) -> None:
        """Append rows as one plain file, seen by others once it is whole."""
        if not rows:
            return
        directory = f"{self.root}/outcome={outcome}"
        self.fs.create_dir(directory, recursive=True)
        name = uuid.uuid4().hex
        hidden = f"{directory}/.{name}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, schema=_ROWS), hidden, filesystem=self.fs)
        self.fs.move(hidden, f"{directory}/part-{name}.parquet")
