"""Bytes of files inside tasks, through pyarrow's file systems (local, s3, gs, hdfs).

Code that runs in tasks travels by value, so executors need no copy of the library.
"""

from __future__ import annotations

import sys
from urllib.parse import unquote, urlsplit

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMES = ("", "file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "abfs", "abfss")


def reachable(path: str) -> bool:
    """Whether tasks can open ``path`` (a store that only the JVM knows can't be)."""
    return urlsplit(path).scheme in SCHEMES


def open_fs(path: str):
    """(pyarrow file system, the path within it) of a URI or local path."""
    from pyarrow import fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path
    if parts.scheme in ("s3a", "s3n", "gcs"):
        path = path.replace(parts.scheme, {"gcs": "gs"}.get(parts.scheme, "s3"), 1)
    return fs.FileSystem.from_uri(path)


def list_files(path: str) -> list[tuple[str, int]]:
    """(URI or path, bytes) of the data files at ``path``: a file, a folder (all
    below it; names with a leading underscore or dot are not data) or a glob in the
    last part of the path."""
    from fnmatch import fnmatchcase

    from pyarrow import fs

    root, name = path.rstrip("/"), ""
    if any(c in path.rsplit("/", 1)[-1] for c in "*?["):
        root, _, name = path.rpartition("/")
    system, inner = open_fs(root)
    info = system.get_file_info(inner)
    prefix = root[:len(root) - len(inner)] if root.endswith(inner) else root.split("://")[0] + "://"
    if info.type == fs.FileType.File:
        return [(root, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    out = []
    for f in found:
        below = f.path[len(inner.rstrip("/")) + 1:]
        hidden = any(part.startswith(("_", ".")) for part in below.split("/"))
        if f.type == fs.FileType.File and not hidden and (not name or fnmatchcase(below.split("/")[0], name)):
            out.append((prefix + f.path, f.size))
    return sorted(out)
