"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import mmap

import pyarrow as pa
import pyarrow.fs as pafs


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file; a path without a scheme is local to all (a shared mount)."""
    return pafs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (pafs.LocalFileSystem(), uri)


def write_stream(uri: str) -> pa.NativeFile:
    """A new file for writing; its folder is made first."""
    fs, path = located(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def read_stream(uri: str) -> pa.NativeFile:
    fs, path = located(uri)
    return fs.open_input_stream(path, compression=None)


def mapped(uri: str):
    """The file's bytes: memory-mapped on a mounted folder, else read from the store."""
    fs, path = located(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as file:
            if file.seek(0, 2) == 0:
                return b""
            return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    with fs.open_input_file(path) as file:
        return file.read()
