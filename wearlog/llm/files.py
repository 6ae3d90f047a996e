"""Files that tasks write and read in the shared folder.

Every attempt of a task writes under names of its own, and only the rows that
its successful attempt returns name files, so a task that is run again leaves
unread files at worst, never half of one in a result.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from wearlog.session import scratch_path


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, made so that all tasks can write there."""
    path = scratch_path(spark, "files", f"{kind}-{uuid.uuid4().hex[:12]}")
    system, place = locate(path)
    system.create_dir(place, recursive=True)
    return path


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:/"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def new_name(folder: str, stem: str, ending: str) -> str:
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:8]}.{ending}"


def write_file(path: str, data: bytes) -> None:
    system, place = locate(path)
    with system.open_output_stream(place, compression=None) as out:
        out.write(data)


def open_file(path: str):
    system, place = locate(path)
    return system.open_input_file(place)
