"""Files that tasks write to and read from the shared folder, on any file system pyarrow knows."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:"):
        uri = uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), os.path.abspath(uri))


def writer(uri: str):
    """An output stream; the folder is made if it is missing."""
    fs, path = _open(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return fs.open_output_stream(path)


def reader(uri: str):
    fs, path = _open(uri)
    return fs.open_input_stream(path)


def attempt_name() -> str:
    """A file name no other attempt of any task has; a manifest names the files of the attempts that succeeded."""
    from pyspark import TaskContext
    return f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
