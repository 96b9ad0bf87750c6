"""Reading and writing whole files of own formats in the shared folder, from tasks."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path (``file:``, ``hdfs:``, ``s3:`` ...)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@contextmanager
def committed(uri: str):
    """A stream to a file that appears under ``uri`` only when it is complete.

    Tasks that run twice write the same bytes under the same name; the last to end stays.
    """
    store, path = open_store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(attempt, compression=None) as out:
        yield out
    store.move(attempt, path)
