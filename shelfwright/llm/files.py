"""Files in the shared folder, read and written by tasks through Arrow's file systems."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from shelfwright.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A URI below the session's shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it. A plain path is a local one."""
    local = re.match(r"(?:file:)?/+(.*)", uri)
    if local:
        return fs.LocalFileSystem(), f"/{local[1]}"
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Write a file whole: under another name first, then moved, so that no reader sees a part of it."""
    system, path = file_system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, path)
