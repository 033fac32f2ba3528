"""Sorted arrays in the shared folder, written by tasks and memory-mapped by workers.

A table is cut into numbered files by key. A task writes a file under a draft name
and renames it, so a repeated task leaves the same file. Readers map files, so
their memory holds pages in use, never the table. Which numbers were written is a file of its own: a reader
takes a number that was not for an empty file, and fails where one that was is missing.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs

_U = np.uint64
THIN = "thin"  # unsigned numbers, a row of them per key: a byte each, 255 for those of 255 or more, then these by place


def range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    """Number of the file of a 64-bit hash, in rising order of the hash."""
    return ((key >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def thin(gaps: np.ndarray) -> tuple[int, bytes]:
    """Unsigned numbers in as many bytes as the largest needs."""
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return width, gaps.astype("<u8").view("u1").reshape(-1, 8)[:, :width].tobytes()


def wide(width: int, data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), "u1")
    out[:, :width] = np.frombuffer(data, "u1").reshape(-1, width)
    return out.view("<u8").ravel()


def thinned(numbers: list[np.ndarray]) -> tuple[bytes, list[int]]:
    """Columns of unsigned numbers of one length, compressed by place of the byte, and the bytes that a number of each takes."""
    widths, planes = [], []
    for n in numbers:
        width, data = thin(n)
        widths.append(width)
        planes.append(np.frombuffer(data, "u1").reshape(-1, width).T.tobytes())
    return len(numbers[0]).to_bytes(8, "little") + pa.compress(b"".join(planes), "zstd", asbytes=True), widths


def widened(data: bytes, widths: list[int]) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 0, []
    planes = np.frombuffer(pa.decompress(data[8:], n * int(sum(widths)), "zstd"), "u1")
    for w in map(int, widths):
        column = np.zeros((n, 8), "u1")
        column[:, :w] = planes[at:at + n * w].reshape(w, n).T
        out.append(column.view("<u8").ravel())
        at += n * w
    return out


def write_array(folder: str, name: str, array: np.ndarray) -> None:
    """Put an array into the shared folder under its final name, in one step."""
    system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), _plain(folder))
    system.create_dir(root, recursive=True)
    draft = f"{root}/{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(array).data)
    system.move(draft, f"{root}/{name}")


def _plain(folder: str) -> str:
    return urlparse(folder).path


def map_array(folder: str, name: str, kind: np.dtype) -> np.ndarray:
    """A read-only map of an array; from a remote store, of a local copy that no name refers to."""
    if urlparse(folder).scheme in ("", "file"):
        path = f"{_plain(folder)}/{name}"
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    system, root = fs.FileSystem.from_uri(folder)
    with tempfile.TemporaryFile() as copy:
        with system.open_input_stream(f"{root}/{name}") as source:
            shutil.copyfileobj(source, copy)
        copy.flush()
        return np.memmap(copy, kind, "r") if copy.tell() else np.empty(0, kind)


def write_thin(folder: str, name: str, rows: np.ndarray) -> None:
    """Unsigned numbers, one or a row of them per key."""
    flat = rows.reshape(-1)
    large = np.flatnonzero(flat >= 255)
    parts = [np.minimum(flat, 255).astype(np.uint8), large.astype("<u8").view(np.uint8), flat[large].astype("<u8").view(np.uint8)]
    write_array(folder, name, np.concatenate(parts))


def write_places(folder: str, name: str, places: list[int]) -> None:
    """Note the numbers under which files of that name were written; one per file, of many keys."""
    write_array(folder, f"{name}.places", np.array(sorted(set(places)), "<i8"))


class _Maps:
    """A worker's maps of one model's files."""

    def __init__(self, folder: str):
        self.folder, self.open, self.places = folder, {}, {}

    def written(self, name: str, number: int) -> bool:
        if name not in self.places:
            self.places[name] = np.array(map_array(self.folder, f"{name}.places", np.dtype("<i8")))
        places = self.places[name]
        at = np.searchsorted(places, number)
        return bool(at < len(places) and places[at] == number)

    def get(self, name: str, kind) -> np.ndarray:
        if name not in self.open:
            self.open[name] = map_array(self.folder, name, np.dtype(kind))
        return self.open[name]


@lru_cache(maxsize=2)
def _maps(folder: str) -> _Maps:
    return _Maps(folder)


def mapped_array(folder: str, name: str, kind) -> np.ndarray:
    """A worker's map of one array that is not cut into files."""
    return _maps(folder).get(name, kind)


def _read_thin(raw: np.ndarray, keys: int, columns: int, at: np.ndarray) -> np.ndarray:
    """The rows of THIN numbers that stand at some places."""
    places = at[:, None] * columns + np.arange(columns)
    found, size = raw[places].astype("<u8"), keys * columns
    large = np.flatnonzero(found.ravel() == 255)
    if len(large):
        where, values = raw[size:].reshape(2, -1)
        found.ravel()[large] = values.view("<u8")[np.searchsorted(where.view("<u8"), places.ravel()[large])]
    return found


def look_up(folder: str, keys: np.ndarray, file: np.ndarray, stored_keys: tuple, values: tuple) -> np.ndarray:
    """The values of sorted keys, each looked for in its numbered file; zero where that lacks it.

    `stored_keys` and `values` are (name, type) of the arrays, which stand side by side; of THIN values, (name, THIN,
    numbers per key).
    """
    maps, (keys_name, keys_kind), (values_name, values_kind, *columns) = _maps(folder), stored_keys, values
    out = np.zeros((len(keys), *columns), "<u8" if values_kind == THIN else values_kind)
    order = np.argsort(file.astype(np.uint16) if file.max(initial=0) < 1 << 16 else file, kind="stable")
    edges = np.flatnonzero(np.diff(file[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        rows = order[a:b]
        n = int(file[rows[0]])
        if not maps.written(keys_name, n):
            continue
        stored = maps.get(f"{keys_name}-{n}", keys_kind)
        if len(stored):
            at = np.minimum(np.searchsorted(stored, keys[rows]), len(stored) - 1)
            hit = stored[at] == keys[rows]
            if values_kind == THIN:
                out[rows[hit]] = _read_thin(maps.get(f"{values_name}-{n}", "u1"), len(stored), columns[0], at[hit])
            else:
                out[rows[hit]] = maps.get(f"{values_name}-{n}", values_kind)[at[hit]]
    return out
