"""Bytes of files in shared storage, for tasks that read a range of a file or write one of their own."""

from __future__ import annotations

import re

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if match := re.match(r"file:/+(.*)", path):
        return fs.LocalFileSystem(), f"/{match[1]}"
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path):
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return fs.LocalFileSystem(), path


class FileBytes:
    """A file's bytes by position, read in blocks of which the last one is kept."""

    def __init__(self, path: str, block: int = 1 << 20):
        system, inner = resolve(path)
        self.file = system.open_input_file(inner)
        self.size, self.block = self.file.size(), block
        self.begin, self.kept = 0, b""

    def at(self, pos: int, n: int) -> bytes:
        """Up to `n` bytes from `pos` on; fewer at the end of the file."""
        if not self.begin <= pos or pos + n > self.begin + len(self.kept):
            self.file.seek(min(pos, self.size))
            self.begin, self.kept = pos, self.file.read(max(n, self.block))
        return self.kept[pos - self.begin : pos - self.begin + n]

    def peek(self, pos: int, n: int) -> bytes:
        """The same for a few bytes elsewhere; what is kept stays."""
        if self.begin <= pos and pos + n <= self.begin + len(self.kept):
            return self.at(pos, n)
        self.file.seek(min(pos, self.size))
        return self.file.read(n)

    def close(self) -> None:
        self.file.close()
