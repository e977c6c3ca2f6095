"""Sorted arrays in files of the shared folder, memory-mapped by the workers that look things up."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyarrow import fs

from wardstat.llm.blocks import new_file, open_file, store


def write_arrays(folder, arrays, extra=b""):
    """Write arrays of equal length, the first of them sorted, and more bytes to a new file; its path."""
    path, out = new_file(folder, ".arrays")
    for array in arrays:
        out.write(np.ascontiguousarray(array).tobytes())
    out.write(extra)
    out.close()
    return path


@lru_cache(10_000)
def mapped(path, rows, kinds, extra):
    """The arrays of a file and the bytes after them, mapped into memory."""
    system, inner = store(path)
    size = sum(np.dtype(k).itemsize for k in kinds) * rows + extra
    if not size:
        return [np.zeros(0, k) for k in kinds], b""
    if isinstance(system, fs.LocalFileSystem):  # a mounted folder
        data = np.asarray(np.memmap(inner, np.uint8, "r"))  # slices of a plain array cost less
    else:
        with open_file(path) as file:
            data = np.frombuffer(file.read(), np.uint8)
    arrays, at = [], 0
    for kind in kinds:
        end = at + np.dtype(kind).itemsize * rows
        arrays.append(data[at:end].view(kind))
        at = end
    return arrays, data[at:]


class SortedTable:
    """Sorted arrays over several files in ascending ranges; ``files`` begin with path, rows, first key, extra bytes."""

    def __init__(self, files, kinds):
        self.files = sorted((f for f in files if f[1]), key=lambda f: f[2])
        self.kinds = tuple(kinds)
        self.firsts = np.array([f[2] for f in self.files], np.int64)
        self.before = np.concatenate([[0], np.cumsum([f[1] for f in self.files])]).astype(np.int64)

    def __len__(self):
        return int(self.before[-1])

    def find(self, keys, wanted=()):
        """Place of each of the sorted keys, -1 if it is not there, and the wanted arrays' values (0 then)."""
        place = np.full(len(keys), -1, np.int64)
        values = [np.zeros(len(keys), self.kinds[i]) for i in wanted]
        bounds = np.append(np.searchsorted(keys, self.firsts), len(keys))
        for i in np.flatnonzero(np.diff(bounds)):
            path, rows, _, extra, *_ = self.files[i]
            arrays, _ = mapped(path, rows, self.kinds, extra)
            some = keys[bounds[i]:bounds[i + 1]]
            at = np.minimum(np.searchsorted(arrays[0], some), rows - 1)
            hit = np.flatnonzero(arrays[0][at] == some)
            place[bounds[i] + hit] = self.before[i] + at[hit]
            for value, k in zip(values, wanted):
                value[bounds[i] + hit] = arrays[k][at[hit]]
        return place, values

    def by_file(self, places):
        """Each file that holds some of the places, and which of them it holds."""
        file = np.searchsorted(self.before, places, "right") - 1
        order = np.argsort(file, kind="stable")
        ends = np.cumsum(np.bincount(file, minlength=len(self.files)))
        for i in np.flatnonzero(np.diff(ends, prepend=0)):
            yield i, order[ends[i - 1] if i else 0:ends[i]]

    def at(self, places, wanted=0):
        """The values of an array at places in any order."""
        made = np.zeros(len(places), self.kinds[wanted])
        for i, some in self.by_file(places):
            path, rows, _, extra, *_ = self.files[i]
            made[some] = mapped(path, rows, self.kinds, extra)[0][wanted][places[some] - self.before[i]]
        return made
