"""Words of a batch of UTF-8 texts as arrays, for tasks that hash many words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (the published splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of rows ``first`` to ``last`` of a batch.

    ``bounds[d]`` to ``bounds[d + 1]`` are the words of row ``first + d``, ``offsets`` in the same
    way its bytes; word w is ``data[starts[w] : ends[w]]``.
    """

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray

    def rows(self) -> np.ndarray:
        """Row of each word, counted from ``first``."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash per word, eight bytes at a time."""
        lengths = self.ends - self.starts
        eights = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        out = mix(lengths.astype(np.uint64) * _ODD + np.uint64(seed))
        live, done = np.arange(len(lengths)), 0
        while live.size:
            left = lengths[live] - done
            block = eights[self.starts[live] + done] & _MASKS[np.minimum(left, 8)]
            out[live] = mix(out[live] * _ODD ^ block)
            live, done = live[left > 8], done + 8
        return out


def chunks(column: pa.Array, between: np.ndarray = _WHITE, becomes: np.ndarray | None = None) -> Iterator[Words]:
    """Cut a text column into pieces of about a megabyte (or one text) and find their words.

    ``between`` marks the bytes that separate words; ``becomes`` replaces bytes first.
    """
    texts = column.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _CHUNK, "right")) - 1)
        part = whole[offsets[first] : offsets[last]]
        part = part if becomes is None else becomes[part]
        yield _words(first, last, part, offsets[first : last + 1] - offsets[first], between)
        first = last


def _words(first: int, last: int, part: np.ndarray, offsets: np.ndarray, between: np.ndarray) -> Words:
    data = np.zeros(len(part) + 8, np.uint8)  # room to read eight bytes anywhere
    data[: len(part)] = part
    inside = ~between[part]
    cut = np.zeros(len(part) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([True], ~inside)) | cut  # no word runs on into this byte
    starts = np.flatnonzero(inside & before[:-1])
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | cut[1:])) + 1 if len(part) else starts
    return Words(first, last, data, starts, ends, np.searchsorted(starts, offsets), offsets)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` neighbours; entry i starts at i (fewer entries than words)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * _ODD + hashes[k : k + n]
    return mix(out)
