"""Word and shingle hashes of whole Arrow batches, without a Python step per word.

A word is a run of bytes that are no separators, with A-Z lower-cased.  Its hash is a
polynomial over its bytes modulo 2**64, mixed at the end.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Everything but ASCII letters and digits and bytes of longer code points.
NOT_ALNUM = np.array([not (chr(b).isascii() and chr(b).isalnum() or b >= 0x80) for b in range(256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        _powers = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, _BASE))]).astype(np.uint64)
    return _powers


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their offsets; a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data, offsets


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def _found(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Lower-cased bytes of the rows between ``offsets``, and start, length and row of every word."""
    first = int(offsets[0])
    part = LOWER[data[first:int(offsets[-1])]]
    n = len(part)
    inside = ~separators[part]
    cut = np.zeros(n + 1, bool)  # a row begins or ends here
    cut[offsets - first] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[:1], before[1:] = True, ~inside[:-1]
    after[-1:], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    lengths = np.flatnonzero(inside & (after | cut[1:])) + 1 - starts
    rows = np.searchsorted(offsets - first, starts, side="right") - 1
    return part, inside, starts, lengths, rows


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, byte length and row of every word of the rows between ``offsets``."""
    part, inside, starts, lengths, rows = _found(data, offsets, separators)
    if not len(starts):
        return np.zeros(0, np.uint64), lengths, rows
    kept = np.flatnonzero(inside)
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(kept)) - np.repeat(heads, lengths)
    hashes = np.add.reduceat(_BYTE[part[kept]] * _power(int(lengths.max()))[place], heads)
    return mix(hashes ^ (lengths.astype(np.uint64) * _STEP)), lengths, rows


def prefixes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the first ``size`` bytes, and row, of every longer word."""
    part, _, starts, lengths, rows = _found(data, offsets, separators)
    longer = lengths > size
    total = np.full(int(longer.sum()), size, np.uint64) * _BASE
    for j in range(size):
        total = (total + _BYTE[part[starts[longer] + j]]) * _BASE
    return mix(total), rows[longer]


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles, in order, and the offsets of each row's.

    A row with fewer words has its whole sequence as one shingle, a row without words none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    heads = np.concatenate([[0], np.cumsum(counts)])
    made = np.maximum(counts - k + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(heads[:-1], made) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], made)
    width = np.repeat(np.minimum(counts, k), made)
    total = width.astype(np.uint64) * _STEP
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    for j in range(k):
        total = np.where(j < width, (total + padded[at + j]) * _BASE, total)
    return mix(total), bounds


def batch_shingles(texts: pa.Array, k: int, separators: np.ndarray = WHITE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of a batch: the first row, the shingle hashes and their offsets by row."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets):
        h, _, rows = words(data, offsets[a:b + 1], separators)
        found, bounds = shingles(h, rows, b - a, k)
        yield a, found, bounds
