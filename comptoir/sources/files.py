"""Opening a file inside a task, by the path Spark gave for it.

Only used where a file must be read front to back by one reader anyway: the fingerprint of a
large file, the first line of a lot, the copy of a lot into the lake. Local paths are opened
directly, others through the Arrow filesystem of their scheme, without holding the file.
"""

from __future__ import annotations

import hashlib
import io
import os
import uuid
from collections.abc import Iterator

CHUNK = 8 * 1024 * 1024


_FILESYSTEMS: dict[tuple[str, str], tuple] = {}


def _filesystem(scheme: str, place: str):
    """Arrow filesystem of a bucket or name node, and the path of its root; one for each in a process."""
    if (scheme, place) not in _FILESYSTEMS:
        from pyarrow import fs
        # s3a is Hadoop's name for what Arrow calls s3.
        _FILESYSTEMS[scheme, place] = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{place}")
    return _FILESYSTEMS[scheme, place]


def _locate(path: str):
    """(None, local path) or (Arrow filesystem, path inside it). Paths are taken as they are, not as URIs."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme or scheme == "file":
        return None, "/" + path.split(":", 1)[-1].lstrip("/")
    place, _, inner = rest.lstrip("/").partition("/")
    filesystem, root = _filesystem(scheme, place)
    return filesystem, f"{root.rstrip('/')}/{inner}"


class _ArrowFile(io.RawIOBase):
    """An Arrow file with the manners of a Python one."""

    def __init__(self, stream):
        self._stream = stream

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        return self._stream.readinto(buffer)

    def tell(self) -> int:
        return self._stream.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self.tell(), io.SEEK_END: self._stream.size()}[whence]
        if start + offset < 0:
            raise OSError("seek before the start of the file")
        return self._stream.seek(start + offset)

    def close(self) -> None:
        self._stream.close()
        super().close()


def open_input(path: str):
    filesystem, inner = _locate(path)
    if filesystem is None:
        return open(inner, "rb")
    return io.BufferedReader(_ArrowFile(filesystem.open_input_file(inner)), CHUNK)


def direct_children(folder: str) -> Iterator[tuple[str, str, int, int]]:
    """(name, path, bytes, modification in microseconds) of the files of a folder, if it exists."""
    filesystem, inner = _locate(folder)
    if filesystem is None:
        if os.path.isdir(inner):
            for entry in os.scandir(inner):
                if entry.is_file():
                    found = entry.stat()
                    yield entry.name, f"file:{entry.path}", found.st_size, found.st_mtime_ns // 1000
        return
    from pyarrow import fs
    for entry in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if entry.type == fs.FileType.File:
            yield (entry.base_name, f"{folder}/{entry.base_name}", entry.size,
                   (entry.mtime_ns or 0) // 1000)


def tree(folder: str, depth: int | None = None) -> Iterator[tuple[str, int | None, int]]:
    """(key relative to the folder, bytes, modification in microseconds) of everything under it.

    Names that start with a dot are left out. With `depth` 1 folders are given too, without bytes,
    and not entered.
    """
    filesystem, inner = _locate(folder)
    if filesystem is None:
        pending = [""]
        while pending:
            below = pending.pop()
            for entry in os.scandir(os.path.join(inner, below)) if os.path.isdir(os.path.join(inner, below)) else ():
                key = f"{below}{entry.name}"
                if entry.name.startswith("."):
                    continue
                if entry.is_dir():
                    if depth is None:
                        pending.append(f"{key}/")
                    else:
                        yield key, None, 0
                else:
                    found = entry.stat()
                    yield key, found.st_size, found.st_mtime_ns // 1000
        return
    from pyarrow import fs
    for entry in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=depth is None)):
        key = entry.path.removeprefix(inner).lstrip("/")
        if any(name.startswith(".") for name in key.split("/")):
            continue
        if entry.type == fs.FileType.File:
            yield key, entry.size, (entry.mtime_ns or 0) // 1000
        elif depth is not None:
            yield key, None, 0


def _pour(reader, writer) -> str:
    """Copy in pieces; returns the SHA-256 of what was copied."""
    digest = hashlib.sha256()
    while piece := reader.read(CHUNK):
        digest.update(piece)
        writer.write(piece)
    return digest.hexdigest()


def _store(reader, path: str) -> str:
    filesystem, inner = _locate(path)
    # Renamed at the end: a lost task must not leave half a file under the final name.
    partial = f"{inner}.{uuid.uuid4().hex}.partial"
    if filesystem is not None:
        if filesystem.type_name in ("s3", "gcs", "abfs"):  # an object appears whole or not at all
            with filesystem.open_output_stream(inner) as writer:
                return _pour(reader, writer)
        filesystem.create_dir(os.path.dirname(inner))
        with filesystem.open_output_stream(partial) as writer:
            fingerprint = _pour(reader, writer)
        filesystem.move(partial, inner)
        return fingerprint
    os.makedirs(os.path.dirname(inner), exist_ok=True)
    with open(partial, "wb") as writer:
        fingerprint = _pour(reader, writer)
    os.replace(partial, inner)
    return fingerprint


def copy_file(origin: str, target: str) -> str:
    """Copy, returning the fingerprint. A task that is run again writes the same file again."""
    with open_input(origin) as reader:
        return _store(reader, target)


def write_file(path: str, content: bytes) -> str:
    return _store(io.BytesIO(content), path)
