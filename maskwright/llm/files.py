"""Byte files in the shared folder, by URI, from driver and tasks alike."""

from __future__ import annotations

from pyarrow import fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or local path; file:/, hdfs:// and object stores that pyarrow knows."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri
