"""Single files, listed, read and written by Arrow's file systems, on the driver and in tasks."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import islice

from pyarrow import fs

LISTED = 10_000  # files a part of a listing


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it. A plain path is a local one."""
    local = re.match(r"(?:file:)?/+(.*)", uri)
    return (fs.LocalFileSystem(), f"/{local[1]}") if local else fs.FileSystem.from_uri(uri)


def listed(uri: str) -> list[fs.FileInfo]:
    """The files of a folder, by name; none if there is no such folder."""
    system, path = file_system(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.base_name)


def listed_in_parts(uri: str) -> Iterator[list[tuple[str, int | None, int | None]]]:
    """``(name, size, changed)`` of the files of a folder, some thousand at a time and in no order.

    A local or mounted folder is read as its names come, so memory holds one part of it; size and time are left to ``stat``, as asking for
    these takes longest. A store of objects has both in its listing, which Arrow gives whole.
    """
    system, path = file_system(uri)
    if isinstance(system, fs.LocalFileSystem):
        found = ((e.name, None, None) for e in os.scandir(path) if e.is_file())
    else:
        found = ((f.base_name, f.size, f.mtime_ns) for f in listed(uri))
    while part := list(islice(found, LISTED)):
        yield part


def is_folder(uri: str) -> bool:
    system, path = file_system(uri)
    return system.get_file_info(path).type == fs.FileType.Directory


def stat(uri: str) -> tuple[int, int] | None:
    """The size of a file and the time of its last change in nanoseconds; None if it is gone."""
    system, path = file_system(uri)
    found = system.get_file_info(path)
    return (found.size, found.mtime_ns) if found.type == fs.FileType.File else None


def read_file(uri: str) -> bytes:
    system, path = file_system(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def write_file(uri: str, data: bytes) -> None:
    """Write a file whole: under another name first, then moved, so that no reader sees a part of it."""
    system, path = file_system(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, path)
