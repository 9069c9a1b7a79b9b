"""Words of whole texts as 64-bit numbers, a column of texts at a time.

The texts of an Arrow column lie one after the other in one buffer. Word bounds are
found on its bytes, and a word's number is a polynomial over its bytes, taken from
running sums; so the work per word does not pass through Python objects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

_U = np.uint64
# Bytes that are hashed together.
_PIECE = 1 << 19
# A longer word gets its number from xxHash: polynomials modulo a power of two give one
# number to certain pairs of words of 1024 bytes, whatever their base.
_LONG = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of a number over all bits (a one-to-one finaliser)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    # Built in the task that needs them, not when the module is imported.
    if not _TABLES:
        _TABLES.extend([_powers(_BASE, _PIECE + 1), _powers(_INVERSE, _PIECE + 1)])
    return _TABLES


def _flags(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Blank bytes of the words [^\x20\x09-\x0D]+.
BLANK = _flags([0x20, *range(0x09, 0x0E)])
#: Bytes outside the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (of lower-cased texts).
NOT_ALNUM = _flags([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_SAME = np.arange(256, dtype=np.uint8)
#: Lower-cases A-Z.
LOWER = np.where((_SAME >= 65) & (_SAME <= 90), _SAME + 32, _SAME).astype(np.uint8)


@dataclass
class Words:
    """Words of a column of texts.

    hashes, starts, ends: of each word, its number and its bytes in `buffer`;
    bounds: text i has the words bounds[i] to bounds[i + 1].
    """

    buffer: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def raw(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]].tobytes()


def joined(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _numbers(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _tables()
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = int(np.searchsorted(ends, first + _PIECE, "right"))
        if j <= i:
            out[i] = xxhash.xxh64_intdigest(buffer[first : ends[i]].tobytes())
            i += 1
            continue
        part = buffer[first : ends[j - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * powers[: len(part)], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    for k in np.flatnonzero(ends - starts > _LONG):
        out[k] = xxhash.xxh64_intdigest(buffer[starts[k] : ends[k]].tobytes())
    return mix(out)


def split(column, between: np.ndarray = BLANK, lower: bool = False) -> Words:
    """Words of every text of an Arrow column of strings; `between`: bytes outside words."""
    buffer, offsets = joined(column)
    if lower and len(buffer):
        buffer = LOWER[buffer]
    n = len(buffer)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(buffer, np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    inside = ~between[buffer]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    begins[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    return Words(buffer, _numbers(buffer, starts, ends), starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A number for each run of `width` words, by its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h *= _U(factor)
        h += hashes[j : j + n]
    return mix(h)


def inner(words: Words, width: int) -> np.ndarray:
    """Of the runs of `width` words over all texts, those that lie within one text."""
    n = max(0, len(words.hashes) - width + 1)
    ok = np.ones(n, bool)
    for end in words.bounds[1:-1]:
        ok[max(0, end - width + 1) : end] = False
    return ok


def runs_of_true(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word, how many flags in a row are set from it on, within its text."""
    n = len(flags)
    at = np.arange(n)
    stop = np.minimum.accumulate(np.where(flags, n, at)[::-1])[::-1]
    return np.minimum(stop, np.repeat(bounds[1:], np.diff(bounds))) - at


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Slices of a batch whose texts have about `limit` bytes together, at least one row each."""
    sizes = np.cumsum(pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(at, end - at)
        at, done = end, int(sizes[end - 1])
