"""One way to open files inside tasks, whatever store holds them.

Spark reads and writes through Hadoop's file systems; code inside a Python task goes through
Arrow's. Paths are the ones Spark shows. Credentials and endpoints of an object store come
from `options`, which the caller passes on to the task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote, urlsplit

import pyarrow.fs

# Hadoop's names of a store, and Arrow's.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfs", "hdfs": "hdfs"}


def open_store(path: str, options: Mapping[str, object] | None = None) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path and the path inside it; raises ValueError for an unknown scheme."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pyarrow.fs.LocalFileSystem(), path
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    if scheme not in SCHEMES:
        raise ValueError(f"no file system for scheme {scheme!r} of {path}; known are file, {', '.join(SCHEMES)}")
    where = urlsplit(f"{SCHEMES[scheme]}:{rest}")
    inside = unquote(f"{where.netloc}{where.path}")
    if SCHEMES[scheme] == "s3":
        return pyarrow.fs.S3FileSystem(**dict(options or {})), inside
    if SCHEMES[scheme] == "gs":
        return pyarrow.fs.GcsFileSystem(**dict(options or {})), inside
    return pyarrow.fs.FileSystem.from_uri(where.geturl())


def readable(path: str) -> str:
    """A path as Spark's readers take it, from the form in which Spark shows it.

    Shown paths are URIs: a space is %20. Readers take plain text, and a pattern where it has
    signs of one, which are escaped.
    """
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def write_file(path: str, data: bytes, options: Mapping[str, object] | None = None) -> None:
    system, name = open_store(path, options)
    folder = name.rpartition("/")[0]
    if folder:
        system.create_dir(folder, recursive=True)
    # Left to itself, Arrow would compress by the ending of the name.
    with system.open_output_stream(name, compression=None) as out:
        out.write(data)
