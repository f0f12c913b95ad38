"""Hashes of words and runs of words, and tables of them in sorted files."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Hashable
from functools import lru_cache

import numpy as np
import pyarrow.fs as fs

# Bytes, or words, whose running sums are taken at once.
PIECE = 1 << 20
# Bytes of shards that a worker keeps in memory, where the folder is no mount.
CACHED_BYTES = 256 << 20
# Hashes up to this number are left free for marks such as the end of a text.
MARKS = 2
ODD, BASE = 0x9E3779B97F4A7C15, 0x2545F4914F6CDD1D


def mix(x: np.ndarray) -> np.ndarray:
    """A mixing of 64 bits that loses nothing (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes starts, and its hash.

    The hash is that of the polynomial of the word's bytes modulo 2^64, taken from running
    sums over a piece of the bytes that ends between two words.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + PIECE, "right")))
        piece = data[origin:ends[last - 1]]
        size = 1 << max(20, int(len(piece)).bit_length())
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * _powers(BASE, size)[:len(piece)],
                  out=sums[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        whole = (sums[b] - sums[a]) * _powers(pow(BASE, -1, 1 << 64), size)[a]
        hashes[first:last] = mix(whole ^ ((b - a).astype(np.uint64) * np.uint64(ODD)))
        first = last
    return starts, np.where(hashes <= MARKS, hashes + np.uint64(MARKS + 1), hashes)


def grouped(keys: list[np.ndarray], values: list[np.ndarray]):
    """Distinct rows of `keys`, in order, and the sums of `values` over equal rows."""
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    at = np.flatnonzero(fresh)
    sums = [np.add.reduceat(v[order].astype(np.int64), at) if len(at) else v[:0].astype(np.int64)
            for v in values]
    return [key[at] for key in keys], sums


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a folder; any scheme that pyarrow knows."""
    if ":" not in folder:
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_table(folder: str, name: str, keys: np.ndarray, rows: np.ndarray) -> None:
    """Write sorted keys and their rows, each file whole or not at all.

    A task that runs again replaces its own files by equal ones.
    """
    files, root = filesystem(folder)
    files.create_dir(root, recursive=True)
    for part, table in (("keys", keys), ("rows", rows)):
        draft = f"{root}/.{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(np.ascontiguousarray(table).tobytes())
        files.move(draft, f"{root}/{name}.{part}")


def mapped(folder: str, name: str, kind: np.dtype) -> np.ndarray:
    """A model file as an array; mapped if the folder is a path that every host mounts."""
    files, root = filesystem(folder)
    path = f"{root}/{name}"
    if not files.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), kind)


class Shards:
    """Arrays of shards as they are asked for, and the latest of them again.

    Mapped arrays take no memory of their own and are kept. Others are kept up to `most` bytes,
    and the one in use; what was not used for longest goes first and is read again when needed.
    """

    def __init__(
        self, read: Callable[[Hashable], tuple[np.ndarray, ...]], most: int | None = None,
    ) -> None:
        self._read, self._most = read, CACHED_BYTES if most is None else most
        self._known: OrderedDict[Hashable, tuple[np.ndarray, ...]] = OrderedDict()
        self._held = 0

    def __getitem__(self, shard: Hashable) -> tuple[np.ndarray, ...]:
        if shard not in self._known:
            self._known[shard] = self._read(shard)
            self._held += self._bytes(shard)
        self._known.move_to_end(shard)
        while self._held > self._most and len(self._known) > 1:
            oldest = next(iter(self._known))
            self._held -= self._bytes(oldest)
            del self._known[oldest]
        return self._known[shard]

    def _bytes(self, shard: Hashable) -> int:
        return sum(part.nbytes for part in self._known[shard] if not isinstance(part, np.memmap))
