"""Byte access to local paths and to URIs of any file system that Arrow knows."""

from __future__ import annotations

import os
import posixpath
import re
from typing import BinaryIO

_URI = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]+:/")


def is_uri(path: str) -> bool:
    return bool(_URI.match(path))


def _place(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def open_bytes(path: str) -> BinaryIO:
    if not is_uri(path):
        return open(path, "rb")
    system, at = _place(path)
    return system.open_input_file(at)


def exists(path: str) -> bool:
    if not is_uri(path):
        return os.path.exists(path)
    from pyarrow import fs

    system, at = _place(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def size(path: str) -> int:
    if not is_uri(path):
        return os.path.getsize(path)
    system, at = _place(path)
    found = system.get_file_info(at).size
    if found is None:
        raise FileNotFoundError(path)
    return found


def read_all(path: str) -> bytes:
    with open_bytes(path) as f:
        return f.read()


def read_if_there(path: str) -> bytes | None:
    try:
        return read_all(path) if exists(path) else None
    except OSError:
        return None


def resolve(directory: str, entry: str) -> str:
    """An entry of a dictionary: absolute paths and URIs stand, others are relative to the dictionary's folder."""
    if is_uri(entry) or os.path.isabs(entry):
        return entry
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]+:/+[^/]*)(/.*)?$", directory) if is_uri(directory) else None
    if m:
        return m[1] + posixpath.normpath(posixpath.join(m[2] or "/", entry))
    return posixpath.normpath(posixpath.join(directory, entry)) if directory else posixpath.normpath(entry)


def search(path: str, search_path: str | None) -> str:
    """A relative path is tried against each comma-separated folder; the first that has it wins, else it stays."""
    if search_path and not is_uri(path) and not os.path.isabs(path) and not os.path.exists(path):
        for folder in filter(None, (x.strip() for x in search_path.split(","))):
            at = f"{folder.rstrip('/')}/{path}"
            if exists(at):
                return at
    return path
