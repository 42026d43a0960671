"""Files in the shared folder that Python code on the executors writes and reads.

A task writes a file whose name no other attempt has, and reports it in its output row; only files named in a manifest
table that Spark has committed are ever read. So a lost executor costs a retry, never a torn or a doubled file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_output(folder: str, stem: str, suffix: str):
    """A new file below folder: its address and an open stream."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_input(address: str):
    """A random-access stream of a file."""
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def open_stream(address: str, ahead: int):
    """A stream of a file from its beginning, `ahead` bytes at a time."""
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_stream(path, compression=None, buffer_size=ahead)
