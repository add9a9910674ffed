"""Binary files on the shared store, written and read inside tasks.

``pyarrow.fs`` opens whatever the folder's scheme names (local or mounted
paths, HDFS, S3). Files get their final name by a rename, so that a retried or
speculative task leaves whole files only.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


@contextmanager
def new_file(path: str):
    """A stream to a new file, which appears under ``path`` once it is whole."""
    store, name = open_store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part, compression=None) as f:
        yield f
    store.move(part, name)


def read_file(path: str) -> bytes:
    store, name = open_store(path)
    with store.open_input_file(name) as f:
        return f.read()
