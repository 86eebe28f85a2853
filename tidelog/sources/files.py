"""Reads and writes of log folders, local (or mounted) or by a file system's URI."""

from __future__ import annotations

import os
from contextlib import contextmanager

import pyarrow.fs as pafs


class Folder:
    """One folder; names in it are files."""

    def __init__(self, path: str):
        self.path = path
        if "://" in path:
            self.fs, self.root = pafs.FileSystem.from_uri(path)
        elif path.startswith("file:"):
            self.fs, self.root = None, path[5:]
        else:
            self.fs, self.root = None, path

    def _at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self) -> bool:
        return os.path.isdir(self.root) if self.fs is None else self.fs.get_file_info(self.root).type == pafs.FileType.Directory

    def has(self, name: str) -> bool:
        return self.size(name) >= 0

    def size(self, name: str) -> int:
        """-1 where there is no such file."""
        if self.fs is None:
            return os.path.getsize(self._at(name)) if os.path.isfile(self._at(name)) else -1
        info = self.fs.get_file_info(self._at(name))
        return info.size if info.type == pafs.FileType.File else -1

    def read(self, name: str, start: int = 0, size: int | None = None) -> bytes:
        if self.fs is None:
            with open(self._at(name), "rb") as f:
                f.seek(start)
                return f.read() if size is None else f.read(size)
        with self.fs.open_input_file(self._at(name)) as f:
            f.seek(start)
            return f.read() if size is None else f.read(size)

    def write(self, name: str, data: bytes) -> None:
        """All of a file."""
        with self.stream(name) as f:
            f.write(data)

    @contextmanager
    def stream(self, name: str):
        """A file to write piece by piece, in place at once where the file system can rename; none after an error."""
        if self.fs is None:
            os.makedirs(self.root, exist_ok=True)
            fresh = self._at(f".{name}.tmp")
            try:
                with open(fresh, "wb") as f:
                    yield f
            except BaseException:
                os.remove(fresh)
                raise
            os.replace(fresh, self._at(name))
            return
        self.fs.create_dir(self.root, recursive=True)
        try:
            with self.fs.open_output_stream(self._at(name)) as f:
                yield f
        except BaseException:
            if self.has(name):
                self.remove(name)
            raise

    def copy(self, name: str, target: Folder, size: int, chunk: int = 8 << 20) -> None:
        """The first ``size`` bytes of a file, to a file of that name, a chunk at a time."""
        with target.stream(name) as f:
            for at in range(0, size, chunk):
                f.write(self.read(name, at, min(chunk, size - at)))

    def rename(self, old: str, new: str) -> None:
        if self.fs is None:
            os.replace(self._at(old), self._at(new))
        else:
            self.fs.move(self._at(old), self._at(new))

    def remove(self, name: str) -> None:
        if self.fs is None:
            os.remove(self._at(name))
        else:
            self.fs.delete_file(self._at(name))
