"""Files that tasks write into and read from the shared folder.

Paths are URIs of any store that Arrow's file systems know (local, HDFS, S3,
GCS), so the same code runs wherever ``spark.checkpoint.dir`` points.  A task
writes under a name of its own and renames at the end: a repeated or
speculative attempt leaves one whole file, never a mixed one.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> str:
    store, path = place(uri)
    store.create_dir(path, recursive=True)
    return uri


@contextmanager
def written(uri: str):
    """An output stream whose file appears under ``uri`` only when all went well."""
    store, path = place(uri)
    folder, _, name = path.rpartition("/")
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        yield out
    store.move(part, path)


def opened(uri: str):
    """A seekable input file."""
    store, path = place(uri)
    return store.open_input_file(path)
