"""Files as tasks see them: the local file system, or a store that pyarrow has a client for, by full path.

A task has no JVM to ask, so folders are listed and files moved here without Spark's readers. On a cluster a path must mean
the same place on each executor: a mounted folder, or a store.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator

#: Schemes that tasks reach, and the name that pyarrow has for them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def scheme(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else "file"


def reachable(path: str) -> bool:
    return scheme(path) in SCHEMES


def store(path: str):
    """The file system of a path; a scheme that tasks don't reach is refused."""
    kind = scheme(path)
    if kind not in SCHEMES:
        raise ValueError(f"tasks reach no {kind}: paths, only {sorted(SCHEMES)}")
    return Local() if kind == "file" else Remote(path)


class Local:
    """Files under ``file:`` paths. Checksum files that Hadoop keeps beside its own are not listed, and go with their file."""

    def at(self, path: str) -> str:
        return re.sub(r"^file:/+", "/", path)

    def _sum(self, path: str) -> str:
        head, name = os.path.split(path)
        return f"{head}/.{name}.crc"

    def _forget_sum(self, path: str) -> None:
        if os.path.exists(self._sum(path)):
            os.unlink(self._sum(path))

    def kind(self, path: str) -> str | None:
        p = self.at(path)
        return "folder" if os.path.isdir(p) else "file" if os.path.exists(p) else None

    def entries(self, folder: str) -> Iterator[tuple[str, int, bool]]:
        """(name, size, is a folder); nothing for a missing folder. Links to folders are not followed."""
        try:
            found = os.scandir(self.at(folder))
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for e in found:
                try:
                    if e.is_dir(follow_symlinks=False):
                        yield e.name, 0, True
                    elif e.is_file() and not (e.name.startswith(".") and e.name.endswith(".crc")):
                        yield e.name, e.stat().st_size, False
                except FileNotFoundError:
                    pass

    def remove(self, path: str) -> None:
        p = self.at(path)
        if os.path.isdir(p):
            shutil.rmtree(p)
        else:
            os.unlink(p)
            self._forget_sum(p)

    def move(self, src: str, dst: str, over: bool = False) -> None:
        """A target that is there is an error, unless ``over``; a file appears at once."""
        a, b = self.at(src), self.at(dst)
        os.makedirs(os.path.dirname(b), exist_ok=True)
        if over:
            os.replace(a, b)
        elif os.path.isdir(a):
            if os.path.lexists(b):
                raise FileExistsError(dst)
            os.rename(a, b)
        else:
            os.link(a, b)
            os.unlink(a)
        self._forget_sum(a)
        self._forget_sum(b)

    def copy(self, src: str, dst: str) -> None:
        a, b = self.at(src), self.at(dst)
        os.makedirs(os.path.dirname(b), exist_ok=True)
        beside = f"{b}.{uuid.uuid4().hex}"
        if os.path.isdir(a):
            shutil.copytree(a, beside)
        else:
            shutil.copyfile(a, beside)
        self.move(beside, dst)

    def write(self, path: str, data: bytes) -> None:
        p = self.at(path)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        beside = f"{p}.{uuid.uuid4().hex}"
        with open(beside, "wb") as f:
            f.write(data)
        os.replace(beside, p)
        self._forget_sum(p)

    def read(self, path: str) -> bytes:
        with open(self.at(path), "rb") as f:
            return f.read()


class Remote:
    """A store that pyarrow has a client for; what is atomic there is the store's affair."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.scheme = scheme(path)
        self.fs, _ = fs.FileSystem.from_uri(SCHEMES[self.scheme] + path[len(self.scheme) :])

    def at(self, path: str) -> str:
        from pyarrow import fs

        return fs.FileSystem.from_uri(SCHEMES[self.scheme] + path[len(self.scheme) :])[1]

    def kind(self, path: str) -> str | None:
        info = self.fs.get_file_info(self.at(path))
        return {"File": "file", "Directory": "folder"}.get(info.type.name)

    def entries(self, folder: str) -> Iterator[tuple[str, int, bool]]:
        from pyarrow import fs

        for info in self.fs.get_file_info(fs.FileSelector(self.at(folder), allow_not_found=True)):
            yield info.base_name, info.size or 0, info.type == fs.FileType.Directory

    def remove(self, path: str) -> None:
        (self.fs.delete_dir if self.kind(path) == "folder" else self.fs.delete_file)(self.at(path))

    def move(self, src: str, dst: str, over: bool = False) -> None:
        if not over and self.kind(dst):
            raise FileExistsError(dst)
        self.fs.create_dir(os.path.dirname(self.at(dst)))
        self.fs.move(self.at(src), self.at(dst))

    def copy(self, src: str, dst: str) -> None:
        if self.kind(dst):
            raise FileExistsError(dst)
        self.fs.create_dir(os.path.dirname(self.at(dst)))
        self.fs.copy_file(self.at(src), self.at(dst))

    def write(self, path: str, data: bytes) -> None:
        self.fs.create_dir(os.path.dirname(self.at(path)))
        with self.fs.open_output_stream(self.at(path)) as f:
            f.write(data)

    def read(self, path: str) -> bytes:
        with self.fs.open_input_stream(self.at(path)) as f:
            return f.read()
