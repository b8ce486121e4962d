"""Flat files in the shared folder, read and written by tasks through Arrow's file systems.

Spark's own readers and writers know no flat binary files. Names hold the attempt that wrote them
and count only when listed in a manifest, which Spark commits; what a lost attempt left is never
read.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def make_dir(path: str) -> None:
    system, name = file_system(path)
    system.create_dir(name, recursive=True)


def attempt_name(what: str) -> str:
    """Unlike any other task attempt's."""
    return f"{what}-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"


def open_write(path: str) -> pa.NativeFile:
    system, name = file_system(path)
    return system.open_output_stream(name, compression=None)


def open_read(path: str) -> pa.NativeFile:
    """A memory map where the file is local; elsewhere a file that reads ranges."""
    system, name = file_system(path)
    return pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
