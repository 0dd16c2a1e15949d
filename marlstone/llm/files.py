"""Binary files that tasks write to and read from shared storage.

A task writes under a name no other attempt uses and reports it as a row; only rows that
Spark has committed name files, so what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from contextlib import contextmanager

from pyarrow import fs as arrow_fs


def located(path: str):
    """File system and path below it; paths may be URIs of any store that Arrow knows."""
    path = re.sub(r"^file:/(?!/)", "file:///", path)
    return arrow_fs.FileSystem.from_uri(path)


def unique_name(folder: str, label: str, suffix: str) -> str:
    return posixpath.join(folder, f"{label}-{uuid.uuid4().hex}{suffix}")


@contextmanager
def writing(path: str):
    store, inner = located(path)
    store.create_dir(posixpath.dirname(inner), recursive=True)
    with store.open_output_stream(inner, compression=None) as out:
        yield out


@contextmanager
def reading(path: str):
    store, inner = located(path)
    with store.open_input_file(inner) as source:
        yield source
