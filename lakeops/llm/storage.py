"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file, hdfs, viewfs, s3, gs, ...) or plain path, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, ending: str) -> str:
    """A name that no other attempt of the same task uses, so a repeated task never writes over another's file."""
    return f"{folder}/{uuid.uuid4().hex}{ending}"


def created(uri: str):
    """Open a new file for writing, with the folders above it."""
    fs, path = opened(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path)


def range_reader(uri: str):
    """An open file with ``read_at(bytes, offset)`` and ``size()``."""
    fs, path = opened(uri)
    return fs.open_input_file(path)
