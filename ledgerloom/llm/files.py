"""Files that tasks write into the shared folder.

Every attempt of a task writes files of its own names; the table of what was written, which Spark commits, names those
of the attempts that counted. Files of lost attempts are never read.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file, local or remote."""
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    fs, path = store(uri)
    with fs.open_input_stream(path, compression=None) as source:
        return source.read()
