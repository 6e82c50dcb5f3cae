"""Files in folders that all nodes reach: paths of a mounted folder, or URIs such as ``hdfs://`` and ``s3://``.

Executors write here, so a path without a scheme must name a folder that every node
mounts.
"""

from __future__ import annotations

import os
import posixpath

from pyarrow import fs as afs


class Folder:
    """A folder of some file system. Files appear whole: they are written under another name and moved."""

    def __init__(self, base: str):
        if "://" in base or base.startswith("file:"):
            self.fs, self.base = afs.FileSystem.from_uri(base)
        else:
            self.fs, self.base = afs.LocalFileSystem(), os.path.abspath(base)

    def at(self, name: str) -> str:
        return posixpath.join(self.base, name.lstrip("/"))

    @property
    def local(self) -> bool:
        return isinstance(self.fs, afs.LocalFileSystem)

    def make(self, name: str = "") -> None:
        self.fs.create_dir(self.at(name), recursive=True)

    def exists(self, name: str = "") -> bool:
        return self.fs.get_file_info(self.at(name)).type != afs.FileType.NotFound

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(self.at(name)) as f:
            return f.read()

    def write(self, name: str, data: bytes, chunk: int | None = None) -> None:
        """Write the bytes, in pieces of ``chunk``; a repeated write changes nothing."""
        at = self.at(name)
        tmp = f"{at}.{os.getpid()}.part"
        with self.fs.open_output_stream(tmp) as f:
            step = chunk or len(data) or 1
            for i in range(0, len(data), step):
                f.write(data[i : i + step])
        self.fs.move(tmp, at)

    def remove(self, name: str) -> None:
        self.fs.delete_file(self.at(name))
