"""Tokens of whole texts, cut from Arrow buffers by byte classes with array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)  # lower-cases A-Z only
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags per byte value: inside one of the inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


def runs_of(ink: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the maximal runs of flagged bytes; no run crosses a document's end.

    ``first`` holds per document the index of its first run, and at last the number of runs.
    """
    if len(ink) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(ink) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(ink & (~np.concatenate([[False], ink[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(ink & (~np.concatenate([ink[1:], [False]]) | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray | None = None) -> pa.Array:
    """Ordered, disjoint byte ranges as an Arrow string array, lower-cased, without bytes that ``keep`` unflags."""
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    taken = np.cumsum(mark[:-1], dtype=np.int8) > 0
    if keep is not None:
        taken &= keep
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(taken, out=place[1:])
    offsets = np.append(place[starts], place[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[taken]]))
