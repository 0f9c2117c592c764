"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``). UTF-8 never uses these bytes inside a
character, so bytes and characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes of text in a slice of rows
HASHED = 1 << 17  # bytes of it that are hashed at a time: the working space is 40 times as large
_MULTIPLIER = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below size."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        steps = np.full(max(size, HASHED + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have


_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; missing texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def slices(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``size`` bytes; a longer text is a run of its own."""
    _, offsets = raw(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def _spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``cuts`` are positions that no word crosses."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of the rows, from the first row's first byte, and the rows' word offsets."""
    base = offsets[0]
    starts, ends = _spans(data[base:offsets[-1]], offsets[1:-1] - base)
    return starts, ends, np.searchsorted(starts, offsets - base, "left")


def hash_spans(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of the words between starts and ends; ``fold`` reads A-Z as a-z."""
    table = _FOLDED if fold else _VALUE
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # words that fit a piece together; a longer word is a piece of its own
        stop = max(int(np.searchsorted(ends, starts[at] + HASHED, "right")), at + 1)
        low, high = starts[at], ends[stop - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[text[low:high]] * _power(_MULTIPLIER, high - low)[:high - low], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * _power(_INVERSE, high - low)[s]
        at = stop
    return mix(out)


def hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows and the rows' offsets into them."""
    starts, ends, bounds = spans(data, offsets)
    return hash_spans(data[offsets[0]:offsets[-1]], starts, ends, fold), bounds


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of values that begin at starts, one after the other."""
    stops = np.cumsum(sizes)
    return values[np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - (stops - sizes), sizes)]


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words, by its first word; runs may cross rows."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = words[:count].copy()
    for i in range(1, size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + count]
    return mix(out)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row with fewer words is one shingle, one without words none."""
    runs = windows(words, size)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(runs[low:high - size + 1])
        elif high > low:
            whole = windows(words[low:high], high - low)
            yield mix(whole + np.uint64(high - low))
        else:
            yield np.zeros(0, np.uint64)
