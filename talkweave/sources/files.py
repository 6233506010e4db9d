"""Files by path or URI (file, hdfs, s3, gs), for tasks and driver alike; a plain path is a folder that all machines share."""

from __future__ import annotations

import io
import os
from contextlib import contextmanager

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def read_bytes(path: str) -> bytes:
    system, at = _place(path)
    with system.open_input_stream(at) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> str:
    """Write a file whole, through another name, so that a task that is tried again or killed leaves no half of it."""
    system, at = _place(path)
    folder, name = at.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    made = f"{folder}/.{os.getpid()}-{name}"
    with system.open_output_stream(made) as f:
        f.write(data)
    system.move(made, at)
    return path


@contextmanager
def writing(path: str):
    """A text file that takes its name when it is whole."""
    system, at = _place(path)
    folder, name = at.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    made = f"{folder}/.{os.getpid()}-{name}"
    with io.TextIOWrapper(system.open_output_stream(made), encoding="utf-8") as f:
        yield f
    system.move(made, at)


def exists(path: str) -> bool:
    system, at = _place(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def absolute(folder: str) -> str:
    return folder.rstrip("/") if "://" in folder or folder.startswith("file:") else os.path.abspath(folder)
