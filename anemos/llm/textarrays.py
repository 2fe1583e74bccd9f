"""Words and shingles of whole texts as flat numpy arrays, without one Python object per word.

An Arrow string column already holds all its texts in one byte buffer. Everything
here works on slices of that buffer of about ``CHUNK`` bytes (one text at least).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 1 << 19
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling (the splitmix64 finalizer)."""
    x = x + _U(_BASE)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()
_BYTE = mix(np.arange(256, dtype=np.uint64))


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial of the values of each span and of its length, equal for equal spans wherever they lie."""
    up, down = _POWERS.reach(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(_BASE)


@dataclass
class Texts:
    """Bytes of some texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``. ``first``: its row in the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array) -> Iterator[Texts]:
    """The texts of an Arrow string column, a bounded number of bytes at a time. A null text has no bytes."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        high = min(high, len(column))
        yield Texts(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], low)
        low = high


@dataclass
class Words:
    """Spans of the words of some texts; text ``i`` has words ``bounds[i]:bounds[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def words(texts: Texts) -> Words:
    """Maximal runs of bytes other than space and 0x09 to 0x0D; no word crosses two texts."""
    solid = ~WHITE[texts.data]
    n = len(solid)
    edge = np.zeros(n + 1, dtype=bool)
    edge[texts.offsets] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    end[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, texts.offsets))


def word_hashes(texts: Texts, spans: Words) -> np.ndarray:
    """A hash of each word with A-Z lower-cased."""
    return mix(span_sums(_BYTE[LOWER[texts.data]], spans.starts, spans.ends))


def shingle_sets(texts: Texts, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct word shingles as sorted 64-bit hashes.

    A text of fewer than ``size`` words has its whole word sequence as the only
    shingle; one without words has none.
    """
    spans = words(texts)
    hashes = word_hashes(texts, spans)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | _U(1)
    flat = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        flat += hashes[k:k + len(flat)] * factors[k]
    flat = mix(flat)
    out = []
    for low, high in zip(spans.bounds[:-1], spans.bounds[1:], strict=True):
        count = high - low
        if count >= size:
            out.append(np.unique(flat[low:high - size + 1]))
        elif count:
            out.append(mix(np.array([(hashes[low:high] * factors[:count]).sum() + _U(count)], dtype=np.uint64)))
        else:
            out.append(flat[:0])
    return out
