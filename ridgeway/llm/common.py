"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII white space that separates words: space, and tab to carriage return.
#: ``bytes.split()`` without an argument splits on exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def texts_of(column) -> Iterator[bytes]:
    """The UTF-8 bytes of each row of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def slices(batches, max_bytes: int = 4 << 20, owner: str | None = None):
    """Record batches cut so that one piece holds at most ``max_bytes`` (or one row),
    whatever the lengths of the texts: bounds the working memory of a task.  What other operators
    left in the worker is freed first, and what the task itself freed goes back to the machine at its end."""
    worker_state(owner)
    for batch in batches:
        pieces = max(1, -(-batch.nbytes // max_bytes))
        step = max(1, -(-batch.num_rows // pieces))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)
    return_memory()


def return_memory() -> None:
    """Gives freed memory of this Python worker back: a worker outlives its tasks, and the allocators keep what
    a task freed, beside the executor's own memory, while other stages run."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the GNU library; others return memory themselves
    if trim is not None:
        trim(0)


def worker_state(owner: str | None) -> dict:
    """A dict that an operator keeps in the Python worker process from task to task: caches kept there are
    rebuilt from nothing when an executor is lost, and never change a result.  It holds the state of one operator: another
    owner (or none) starts with an empty one, so no stage carries the memory of an earlier one."""
    module = sys.modules.setdefault("ridgeway_worker_state", types.ModuleType("ridgeway_worker_state"))
    held = vars(module).setdefault("held", {})
    if held.get("owner") != owner:
        held.clear()
        held["owner"] = owner
    return held


def local_path(uri: str) -> str:
    """The path of a ``file:`` URI (or of a plain path)."""
    return uri.removeprefix("file://").removeprefix("file:") if uri.startswith("file:") else uri


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a shared folder named by a URI."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), local_path(uri)
    return fs.FileSystem.from_uri(uri)


class AttemptFile:
    """An output file with a name no other task attempt uses.

    Written under a temporary name, renamed when closed in good order.  Readers only
    follow a manifest that Spark's commit protocol wrote, so files left by lost or
    repeated attempts are never read.
    """

    def __init__(self, folder: str, suffix: str):
        self.fs, base = filesystem(folder)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self._final = f"{base.rstrip('/')}/{self.name}"
        self._temp = f"{self._final}.part"
        self.fs.create_dir(base, recursive=True)
        self.stream = self.fs.open_output_stream(self._temp)

    def close(self) -> str:
        self.stream.close()
        self.fs.move(self._temp, self._final)
        return self.name

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            self.close()
        else:
            self.stream.close()


def open_input(folder: str, name: str):
    """A random-access file of a shared folder; memory-mapped where the store is a file system."""
    fs_, base = filesystem(folder)
    path = f"{base.rstrip('/')}/{name}"
    if type(fs_).__name__ == "LocalFileSystem" and os.path.getsize(path):
        return pa.memory_map(path)
    return fs_.open_input_file(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Shared:
    """A broadcast of an object of this package; the class travels with it by value, so
    executors need no copy of the package."""

    def __init__(self, spark, value):
        from pyspark import cloudpickle

        self._broadcast = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        import pickle

        return pickle.loads(self._broadcast.value)


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: the byte
    itself where it is printable Latin-1, else the next character from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Cache(dict):
    """Two generations of at most ``size`` bytes each (entries counted with their overhead): what is in use
    survives, memory is bounded."""

    ENTRY = 200   # bytes of an entry beside its characters and its value

    def __init__(self, make, size: int, longest: int = 64):
        self.make, self.size, self.longest, self.old, self.held = make, size, longest, {}, 0

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self._keep((key,), (value,))
        return value

    def all(self, keys: list[str], make) -> list[bytes]:
        """The values of distinct keys; ``make`` gives those of a list of keys that are not held."""
        values = list(map(self.get, keys))
        new = [k for k, value in enumerate(values) if value is None]
        moved = [keys[k] for k in new]
        found = list(map(self.old.get, moved))
        made = iter(make([key for key, value in zip(moved, found) if value is None]))
        found = [next(made) if value is None else value for value in found]
        for k, value in zip(new, found):
            values[k] = value
        self._keep(moved, found)
        return values

    def _keep(self, keys, values) -> None:
        for key, value in zip(keys, values):
            if self.held >= self.size:
                self.old = dict(self)
                self.clear()
                self.held = 0
            if len(key) <= self.longest:
                self[key] = value
                self.held += len(key) + len(value) + self.ENTRY
