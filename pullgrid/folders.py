"""Folders as the driver sees them, through the session's Hadoop file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# bodies, names and addresses repeat most of their text from row to row
PACKED = {"compression": "zstd"}


def _open(spark: SparkSession, uri: str):
    """(file system, path, Hadoop classes)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, hadoop


def qualified(spark: SparkSession, uri: str) -> str:
    """The URI with its scheme, so that driver and workers mean the same folder."""
    fs, path, _ = _open(spark, uri)
    return fs.makeQualified(path).toString().rstrip("/")


def ready_dir(spark: SparkSession, uri: str) -> str:
    """The folder's full URI; made for everyone if absent. The file system says if we may use it."""
    fs, path, hadoop = _open(spark, uri)
    full = fs.makeQualified(path).toString()
    kind = fs.getFileStatus(path) if fs.exists(path) else None
    if kind is None:
        fs.mkdirs(path)
        fs.setPermission(path, hadoop.permission.FsPermission("777"))
    elif kind.isFile():
        raise ValueError(f"a cache folder is wanted, but {full} is not a directory")
    try:
        fs.access(path, hadoop.permission.FsAction.READ_WRITE)
    except Exception as refused:
        raise ValueError(f"no right to read and write in {full}: {refused}") from refused
    return full


def there(spark: SparkSession, uri: str) -> bool:
    fs, path, _ = _open(spark, uri)
    return fs.exists(path)


def complete_dirs(spark: SparkSession, parent: str, key: str) -> list[int]:
    """n of every ``<key>=<n>`` below ``parent`` that has a success mark."""
    fs, path, hadoop = _open(spark, parent)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        mark = hadoop.Path(status.getPath(), "_SUCCESS")
        if status.isDirectory() and name.startswith(f"{key}=") and fs.exists(mark):
            found.append(int(name[len(key) + 1 :]))
    return sorted(found)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local temporary one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return qualified(spark, configured)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="pullgrid-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory path under the shared folder (not created)."""
    return f"{shared_dir(spark)}/pullgrid-{name}-{uuid.uuid4().hex[:12]}"


def create_once(spark: SparkSession, uri: str, text: str) -> bool:
    """Make a file with this text unless there is one; whether it is ours.

    The file system's exclusive create decides between two writers.
    """
    fs, path, _ = _open(spark, uri)
    try:
        out = fs.create(path, False)
    except Exception:
        if fs.exists(path):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def text_of(spark: SparkSession, uri: str) -> str:
    """A small file's text."""
    fs, path, _ = _open(spark, uri)
    source = fs.open(path)
    try:
        raw = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)
    finally:
        source.close()
    return bytes(raw).decode()


def names_in(spark: SparkSession, uri: str) -> dict[str, int]:
    """Names in a folder and when they were last written (milliseconds); none if it is absent."""
    fs, path, _ = _open(spark, uri)
    if not fs.exists(path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path)}


def remove(spark: SparkSession, uri: str) -> None:
    fs, path, _ = _open(spark, uri)
    fs.delete(path, True)
