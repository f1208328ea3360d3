"""Words of whole Arrow batches as numpy arrays: borders, hashes and per-document ranges.

Texts are handled as UTF-8 bytes, many documents at once, so that no Python runs per word. Null texts are
empty texts. Work is done in slices of about ``SLICE`` bytes whatever the length of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

_LETTERS_DIGITS = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[_LETTERS_DIGITS] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and the n + 1 borders between them."""
    filled = pc.fill_null(texts, "").cast(pa.large_binary())
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = filled.buffers()
    borders = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    if data is None or borders[-1] == borders[0]:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[borders[0]:borders[-1]], borders - borders[0]


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text each; one longer text is a range of its own."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, stop
        start = stop


def runs(data: np.ndarray, borders: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes marked in ``inside``; a run ends at a border."""
    member = inside[data]
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    inner = borders[(borders > 0) & (borders < len(data))]
    first[inner] = member[inner]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(length).bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def mix(keys: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    keys = keys ^ (keys >> np.uint64(30))
    keys = keys * np.uint64(0xBF58476D1CE4E5B9)
    keys = keys ^ (keys >> np.uint64(27))
    keys = keys * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes; equal bytes have equal hashes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        part = data[base:int(ends[j - 1])]
        power, inverse = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    return mix(out)


def lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray, missing) -> np.ndarray:
    """``values`` of ``keys`` in the sorted ``table``; ``missing`` where a key is not in it."""
    if len(table) == 0:
        return np.full(len(keys), missing, values.dtype)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], missing)
