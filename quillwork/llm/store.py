"""Files that executors write to and read from the shared folder, by any URI that pyarrow knows."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def published(uri: str):
    """Write a file under a name of its own and give it its name at the end: a repeated or lost task harms nothing."""
    system, path = at(uri)
    parent = path.rpartition("/")[0]
    system.create_dir(parent, recursive=True)
    hidden = f"{parent}/.{uuid.uuid4().hex}"
    done = False
    try:
        with system.open_output_stream(hidden, compression=None) as f:
            yield f
        done = True
    finally:
        if not done and system.get_file_info(hidden).type != fs.FileType.NotFound:
            system.delete_file(hidden)
    system.move(hidden, path)


@contextmanager
def random_access(uri: str):
    system, path = at(uri)
    with system.open_input_file(path) as f:
        yield f
