"""The listing log of a poll: one folder per tick, complete once it has a manifest.

    tick=<n>/begun           when a poll began the tick, and the walks that list it
    tick=<n>/walk-<i>...     what the task of a walk listed; the first whole file stays
    tick=<n>/run-<token>/    what a Spark job listed
    tick=<n>/manifest.json   made only if absent: the files that are the tick

A task writes under a name of its own and then claims the walk's name, so a task that
runs twice finds the first listing and emits that. Whoever claims the last walk
writes the manifest. Nothing is renamed over something else, and the driver sees names
and counts only.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileType, LocalFileSystem

from pullgrid.operators.slicing import slice_bounds
from pullgrid.sources.options import Walk
from pullgrid.sources.storage import open_dir

LOG_SCHEMA = pa.schema(
    [
        ("full_name", pa.string()),
        ("rank", pa.int64()),
        ("id", pa.int64()),
        ("number", pa.int32()),
        ("url", pa.string()),
        ("version", pa.string()),
    ]
)
BEGUN, MANIFEST = "begun", "manifest.json"
ROWS_AT_ONCE = 10_000
# (file, row group, first row, end row)
Segment = tuple[str, int, int, int]


def claim(fs, own: str, name: str) -> bool:
    """Give a written file a name unless that is taken; whether it is ours.

    Local and distributed file systems refuse a rename or link onto a file.
    """
    if isinstance(fs, LocalFileSystem):
        try:
            os.link(own, name)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    try:
        if fs.get_file_info(name).type == FileType.NotFound:
            fs.move(own, name)
            return True
    except OSError:
        if fs.get_file_info(name).type == FileType.NotFound:
            raise
    fs.delete_file(own)
    return False


def _write_once(fs, name: str, text: str) -> bool:
    own = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        out.write(text.encode())
    return claim(fs, own, name)


def _text(fs, name: str) -> str | None:
    if fs.get_file_info(name).type != FileType.File:
        return None
    with fs.open_input_stream(name) as source:
        return source.read().decode()


def _tick_dir(log_dir: str, tick: int):
    fs, path = open_dir(log_dir)
    return fs, f"{path}/tick={tick}"


def last_tick(log_dir: str) -> tuple[int, float]:
    """(number of the newest tick begun or complete, or 0; seconds since it was)."""
    fs, path = open_dir(log_dir)
    folders = fs.get_file_info(FileSelector(path, allow_not_found=True))
    ticks = sorted(
        (int(f.base_name[5:]) for f in folders if f.base_name.startswith("tick=")), reverse=True
    )
    for tick in ticks:
        for mark in (BEGUN, MANIFEST):
            info = fs.get_file_info(f"{path}/tick={tick}/{mark}")
            if info.type == FileType.File:
                return tick, time.time() - info.mtime.timestamp()
    return 0, float("inf")


def check_identity(log_dir: str, identity: str) -> None:
    """Refuse a log that another poll has begun; a new one is marked as ours."""
    fs, path = open_dir(log_dir)
    fs.create_dir(path, recursive=True)
    mark = f"{path}/_identity"
    if _text(fs, mark) is None:
        _write_once(fs, mark, identity)
    if _text(fs, mark) != identity:
        raise ValueError(f"the listing log {log_dir} belongs to other repositories")


def begin_tick(log_dir: str, tick: int, walks: list[Walk]) -> None:
    """Fix the walks of a tick; a tick that someone else has begun keeps theirs."""
    fs, folder = _tick_dir(log_dir, tick)
    fs.create_dir(folder, recursive=True)
    _write_once(fs, f"{folder}/{BEGUN}", json.dumps(walks))


def open_walks(log_dir: str, tick: int) -> list[Walk] | None:
    """The walks of a tick that is begun and has no manifest yet."""
    fs, folder = _tick_dir(log_dir, tick)
    begun = _text(fs, f"{folder}/{BEGUN}")
    if begun is None or _text(fs, f"{folder}/{MANIFEST}") is not None:
        return None
    return [Walk(*w) for w in json.loads(begun)]


def _write_part(fs, name: str, rows: Iterable[dict]) -> None:
    rows = iter(rows)
    with fs.open_output_stream(name) as sink, pq.ParquetWriter(sink, LOG_SCHEMA) as out:
        while some := list(islice(rows, ROWS_AT_ONCE)):
            out.write_table(pa.Table.from_pylist(some, schema=LOG_SCHEMA))


def list_walk(log_dir: str, tick: int, walk: int, rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    """A walk's rows as the log has them: listed now unless they have been already.

    ``rows`` is not touched where the walk is in the log.
    """
    fs, folder = _tick_dir(log_dir, tick)
    name = f"{folder}/walk-{walk}.parquet"
    if fs.get_file_info(name).type != FileType.File:
        own = f"{folder}/.walk-{walk}-{uuid.uuid4().hex}"
        _write_part(fs, own, rows)
        claim(fs, own, name)
    with pq.ParquetFile(fs.open_input_file(name)) as source:
        yield from source.iter_batches(ROWS_AT_ONCE, columns=LOG_SCHEMA.names)


def finish_tick(log_dir: str, tick: int, walks: int) -> bool:
    """Write the manifest if all walks are listed; whether the tick is complete."""
    fs, folder = _tick_dir(log_dir, tick)
    names = [f"walk-{k}.parquet" for k in range(walks)]
    there = fs.get_file_info([f"{folder}/{n}" for n in names])
    if any(t.type != FileType.File for t in there):
        return False
    _commit(fs, folder, names)
    return True


def _commit(fs, folder: str, names: list[str]) -> None:
    _write_once(fs, f"{folder}/{MANIFEST}", manifest_text(names))


def manifest_text(names: list[str]) -> str:
    return json.dumps({"parts": names}) + "\n"


def write_tick(log_dir: str, tick: int, rows: list[dict]) -> None:
    """Write a small snapshot as one tick, unless there is one: the first manifest stays."""
    fs, folder = _tick_dir(log_dir, tick)
    run = f"run-{uuid.uuid4().hex}"
    fs.create_dir(f"{folder}/{run}", recursive=True)
    _write_part(fs, f"{folder}/{run}/part-0.parquet", rows)
    _commit(fs, folder, [f"{run}/part-0.parquet"])


def parts_of(log_dir: str, tick: int) -> list[str]:
    """The files of a complete tick."""
    fs, folder = _tick_dir(log_dir, tick)
    text = _text(fs, f"{folder}/{MANIFEST}")
    if text is None:
        raise RuntimeError(f"Listing log {log_dir} has no complete tick {tick}")
    return [f"{folder}/{name}" for name in json.loads(text)["parts"]]


def plan_tick(log_dir: str, tick: int, slices: int) -> list[list[Segment]]:
    """Contiguous balanced slices of a snapshot, from file footers alone."""
    fs, _ = open_dir(log_dir)
    groups = []
    for path in sorted(parts_of(log_dir, tick)):
        meta = pq.read_metadata(path, filesystem=fs)
        groups += [(path, g, meta.row_group(g).num_rows) for g in range(meta.num_row_groups)]
    total = sum(g[2] for g in groups)
    if total == 0:
        return []
    out, position, current = [], 0, 0
    for low, high in slice_bounds(total, min(slices, total)):
        segments = []
        while low < high:
            name, group, rows = groups[current]
            take = min(high, position + rows) - low
            segments.append((name, group, low - position, low - position + take))
            low += take
            if low == position + rows:
                position, current = position + rows, current + 1
        out.append(segments)
    return out


def read_segments(log_dir: str, segments: list[Segment]) -> Iterator[pa.RecordBatch]:
    """Rows of a slice, as record batches."""
    fs, _ = open_dir(log_dir)
    for name, group, low, high in segments:
        with pq.ParquetFile(fs.open_input_file(name)) as source:
            table = source.read_row_group(group, columns=LOG_SCHEMA.names)
        yield from table.slice(low, high - low).to_batches()
