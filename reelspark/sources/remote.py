"""File access inside tasks, on any filesystem pyarrow knows."""

from __future__ import annotations

from pyarrow import fs as pafs


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and inner path of a URI or an absolute local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def open_file(path: str):
    system, inner = open_filesystem(path)
    return system.open_input_file(inner)


def read_range(path: str, at: int, size: int) -> bytes:
    """Bytes from a position; empty when the file cannot be read."""
    try:
        with open_file(path) as f:
            f.seek(at)
            return f.read(size)
    except OSError:
        return b""
