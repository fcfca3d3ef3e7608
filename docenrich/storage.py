"""Open, list and replace single files from inside a task.

Plain paths and ``file:`` URIs use the operating system; any other scheme goes
through ``pyarrow.fs``.
"""

import contextlib
import ctypes
import functools
import os
import re
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs

from docenrich.constants import READ_AHEAD_BYTES, WORKERS_PER_PARTITION

# Hadoop's names for a scheme that pyarrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_BATCH_ROWS = 2000
_BATCH_BYTES = 8 << 20


# What says of a path that no file is there, now or on a second try.
NOT_THERE = (FileNotFoundError, NotADirectoryError, IsADirectoryError)
# And of a file that it is there, but not for us.
UNREADABLE = (*NOT_THERE, PermissionError)

_LOST_BYTE = re.compile("[\udc80-\udcff]")
_ESCAPED_BYTE = re.compile("\0([0-9a-f]{2})")


def path_text(path: str) -> str:
    """A path as UTF-8 can carry it: a byte that is no text becomes NUL and two
    hexadecimal digits. No path holds a NUL, so ``local_path`` can undo it."""
    return _LOST_BYTE.sub(lambda found: f"\0{ord(found[0]) - 0xDC00:02x}", path)


def local_path(path: str) -> str | None:
    """The path on a mounted file system, or None for a remote scheme."""
    path = _ESCAPED_BYTE.sub(lambda found: chr(0xDC00 + int(found[1], 16)), path)
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return None if "://" in path else path


@functools.lru_cache(maxsize=64)
def _filesystem(base: str) -> tuple[fs.FileSystem, str]:
    """File system of ``scheme://authority`` and what its own paths start with."""
    scheme, authority = base.split("://", 1)
    filesystem, start = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{authority}/")
    return filesystem, start if start in ("", "/") else start.rstrip("/") + "/"


def _remote(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, its own path, and the text to replace that path's start by.

    Only scheme and authority are parsed as a URI: names may hold blanks and
    per cent signs that mean themselves.
    """
    scheme, rest = path.split("://", 1)
    authority, _, key = rest.partition("/")
    base = f"{scheme}://{authority}"
    filesystem, start = _filesystem(base)
    return filesystem, start + key, start


def read_file(path: str) -> bytes:
    local = local_path(path)
    if local is not None:
        with open(local, "rb") as handle:
            return handle.read()
    filesystem, name, _ = _remote(path)
    with filesystem.open_input_stream(name) as handle:
        return handle.read()


def file_facts(path: str) -> tuple[float, int] | None:
    """Seconds since 1970 of the last change, and the length; None if it is gone."""
    local = local_path(path)
    if local is not None:
        try:
            found = os.stat(local)
        except NOT_THERE:
            return None
        return found.st_mtime, found.st_size
    filesystem, name, _ = _remote(path)
    info = filesystem.get_file_info(name)
    return None if info.size is None else (info.mtime_ns / 1e9, info.size)


def file_length(path: str) -> int:
    """Bytes of a file; 0 if that cannot be told."""
    try:
        facts = file_facts(path)
    except OSError:
        return 0
    return facts[1] if facts else 0


def read_ahead(
    paths: Iterable[str], budget: int = READ_AHEAD_BYTES
) -> Iterator[tuple[str, Future]]:
    """Paths in order, each with its bytes to come: the next few files are read
    while one is being worked on.

    Files are admitted in order, by their lengths: those read ahead have ``budget``
    bytes together at most, and a file that is longer by itself is read alone.
    """
    waiting: deque[tuple[str, Future, int]] = deque()
    held = 0
    with ThreadPoolExecutor(WORKERS_PER_PARTITION) as pool:
        for path, length in _measured(paths, pool):
            while waiting and (len(waiting) >= WORKERS_PER_PARTITION or held + length > budget):
                first, coming, size = waiting.popleft()
                yield first, coming
                # whoever took it is done with it now
                del coming
                held -= size
            waiting.append((path, pool.submit(read_file, path), length))
            held += length
        while waiting:
            first, coming, _ = waiting.popleft()
            yield first, coming
            del coming


def _measured(paths: Iterable[str], pool: ThreadPoolExecutor) -> Iterator[tuple[str, int]]:
    """Paths in order with their lengths, which are looked up a few at a time."""
    coming: deque[tuple[str, Future]] = deque()
    for path in paths:
        coming.append((path, pool.submit(file_length, path)))
        if len(coming) >= WORKERS_PER_PARTITION:
            first, length = coming.popleft()
            yield first, length.result()
    for first, length in coming:
        yield first, length.result()


def new_file(path: str) -> BinaryIO:
    """A new file on a mounted file system, with the folders above it."""
    local = local_path(path)
    try:
        return open(local, "xb")
    except FileNotFoundError:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "xb")


def replace_file(path: str, data: bytes) -> None:
    """Write a whole file so that readers see the old one or the new one."""
    local = local_path(path)
    if local is not None:
        folder = os.path.dirname(local)
        # the leading dot keeps half-written files out of every listing
        partial = os.path.join(folder, f".{uuid.uuid4().hex}.part")
        try:
            handle = open(partial, "wb")
        except FileNotFoundError:
            os.makedirs(folder, exist_ok=True)
            handle = open(partial, "wb")
        with handle:
            handle.write(data)
        os.replace(partial, local)
        return
    # object stores publish an object only when the stream is closed
    filesystem, name, _ = _remote(path)
    with filesystem.open_output_stream(name) as handle:
        handle.write(data)


def list_folder(folder: str) -> Iterator[tuple[str, bool]]:
    """(path, descend) for each entry: True for a folder, False for a file.

    A missing folder has no entries; one that cannot be read is an error. Links
    to folders are not followed. Mounted folders are read entry by entry; a remote one arrives as
    one list, so huge flat ones are better listed by Spark's own index.
    """
    local = local_path(folder)
    if local is not None:
        try:
            entries = os.scandir(local)
        except (FileNotFoundError, NotADirectoryError):
            return
        with entries:
            for entry in entries:
                if not entry.is_dir():
                    yield entry.path, False
                elif not entry.is_symlink():
                    yield entry.path, True
        return
    filesystem, name, start = _remote(folder)
    base = folder[: len(folder) - len(name.removeprefix(start))]
    selector = fs.FileSelector(name, allow_not_found=True, recursive=False)
    for info in filesystem.get_file_info(selector):
        yield base + info.path.removeprefix(start), info.type == fs.FileType.Directory


def arrow_batches(
    sized_rows: Iterable[tuple[dict, int]], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows with their sizes as batches that stay small, whatever the rows hold."""
    rows: list[dict] = []
    held = 0
    for row, size in sized_rows:
        rows.append(row)
        held += size
        if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def released(task: Callable) -> Callable:
    """An Arrow task that gives the memory it has freed back to the system at its end.

    The worker process goes on to other tasks, and waits idle while the JVM needs the room.
    """

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def valid_text(text: str | None) -> str | None:
    """The text as UTF-8 can carry it: half characters become question marks."""
    if text is None or text.isascii():
        return text
    return text.encode("utf-8", "replace").decode()


def describe(problem: Exception) -> str:
    """The message of an exception, or its name if it has none."""
    return valid_text(str(problem)) or type(problem).__name__
