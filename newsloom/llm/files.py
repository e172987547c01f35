"""Binary files in the folder that all machines of the cluster share.

Spark has no writer for formats such as WARC, so tasks write these files through
Arrow's file systems. A file gets a name of its own per attempt and counts only
if the row that names it is in the stored manifest: the files of lost or repeated
attempts are never read.
"""

from __future__ import annotations

import posixpath
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from newsloom.lineage import checkpoint_dir


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    uri = re.sub(r"^file:/+", "/", uri)
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def opened(uri: str) -> pa.NativeFile:
    """A file of the shared folder, for reading."""
    system, path = _opened(uri)
    return system.open_input_file(path)


class NewFile:
    """A file under construction: append bytes, learn where they begin."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.uri = posixpath.join(folder, f"{stem}-{uuid.uuid4().hex}{suffix}")
        system, path = _opened(self.uri)
        system.create_dir(posixpath.dirname(path), recursive=True)
        self._stream, self.size = system.open_output_stream(path, compression=None), 0

    def append(self, data: bytes) -> int:
        start = self.size
        self._stream.write(data)
        self.size += len(data)
        return start

    def close(self) -> None:
        self._stream.close()


class Ranges:
    """Reads byte ranges; keeps the last file open."""

    def __init__(self):
        self._uri, self._file = None, None

    def read(self, uri: str, start: int, length: int) -> bytes:
        if uri != self._uri:
            self.close()
            system, path = _opened(uri)
            self._uri, self._file = uri, system.open_input_file(path)
        self._file.seek(start)
        return self._file.read(length)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._uri, self._file = None, None
