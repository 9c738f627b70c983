"""Words and word shingles of whole texts as 64-bit hashes, in NumPy over Arrow string buffers.

Words are runs of bytes other than the six white space characters, with A-Z lower-cased. All functions work on a
batch; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
HASHED_BYTES = 1 << 20  # hashed at once: 64-bit numbers per byte are held for so much only, also within one long text
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def random_words(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, _MASK, n, dtype=np.uint64, endpoint=True)


_BYTE = random_words(256, 1)
for _upper in range(65, 91):  # one value for both cases of a letter
    _BYTE[_upper] = _BYTE[_upper + 32]
_PLACE = random_words(8, 2) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse. Tables up to the size of a slice are kept."""
    if n > SLICE_BYTES + 1:
        return _powers_of(_R, n), _powers_of(_R_INVERSE, n)
    if not _powers or len(_powers["up"]) < n:
        size = HASHED_BYTES + 1 if n <= HASHED_BYTES + 1 else SLICE_BYTES + 1
        _powers.update(up=_powers_of(_R, size), down=_powers_of(_R_INVERSE, size))
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes together (or one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    if not len(sizes):
        return
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield begin, end
        begin = end


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after the other, and where each row begins (and the last ends)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each row the index of its first word (and the end)."""
    data, offsets = buffers(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    breaks = np.zeros(n + 1, bool)
    breaks[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | breaks[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | breaks[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    h, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + HASHED_BYTES, "right")))
        part = data[low : ends[j - 1]]
        up, down = _power_table(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up, dtype=np.uint64, out=sums[1:])
        h[i:j] = mixed((sums[ends[i:j] - low] - sums[starts[i:j] - low]) * down[starts[i:j] - low])
        i = j
    return h, np.searchsorted(starts, offsets)


def shingles(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of every row (with repeats), and for each row the index of its first one (and the end).

    A row with 1 to k - 1 words has one shingle, the whole sequence; a row without words has none.
    """
    h, at = words(texts)
    counts = np.diff(at)
    out_counts = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(out_counts)]).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), out_counts)
    begin = at[:-1][row] + np.arange(out_at[-1]) - out_at[:-1][row]
    long = counts[row] >= k
    length = np.where(long, k, counts[row])
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    total = np.zeros(len(row), np.uint64)
    for j in range(k):
        total += np.where(j < length, padded[begin + j] * _PLACE[j], np.uint64(0)) if not long.all() else padded[begin + j] * _PLACE[j]
    return mixed(total + length.astype(np.uint64)), out_at


def shingle_sets(texts: pa.Array, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    h, at = shingles(texts, k)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
