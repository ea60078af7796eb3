"""Directories as tasks see them (through Arrow file systems)."""

from __future__ import annotations

import os

from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem


def open_dir(uri: str):
    """(file system, path) of a directory URI; a plain path is a local one."""
    if uri.startswith("file:"):
        return LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        return FileSystem.from_uri(uri)
    return LocalFileSystem(), uri


def check_cache_dir(uri: str) -> str:
    """The folder's full URI, made if absent; tells at planning time if it cannot be used.

    Runs where no session is; a remote file system refuses by itself when it is used.
    """
    fs, path = open_dir(uri)
    if not isinstance(fs, LocalFileSystem):
        fs.create_dir(path, recursive=True)
        return uri
    if not os.path.lexists(path):
        os.makedirs(path)
        os.chmod(path, 0o777)
    if not os.path.isdir(path):
        raise ValueError(f"a cache folder is wanted, but {path} is not a directory")
    if not os.access(path, os.R_OK | os.W_OK | os.X_OK):
        raise ValueError(f"no right to read and write in {path}")
    return f"file:{path}"


def complete_dirs(parent: str, key: str) -> dict[int, float]:
    """``<key>=<n>`` directories with a success mark: n -> time of the mark."""
    fs, path = open_dir(parent)
    found = {}
    for entry in fs.get_file_info(FileSelector(path, allow_not_found=True)):
        if entry.type == FileType.Directory and entry.base_name.startswith(f"{key}="):
            mark = fs.get_file_info(f"{entry.path}/_SUCCESS")
            if mark.type == FileType.File:
                found[int(entry.base_name[len(key) + 1 :])] = mark.mtime.timestamp()
    return found
