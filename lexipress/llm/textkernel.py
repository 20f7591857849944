"""Words of whole Arrow text columns and their 64-bit hashes, in numpy.

Word classes are classes of bytes: in UTF-8 every byte of a character beyond ASCII
is 0x80 or above, so a class that holds all such characters can be told by byte.

A word's hash is its polynomial in an odd base modulo 2**64, taken from one running
sum over the bytes, then mixed.  Hashes find candidates; what must be exact is
verified by a second, independent hash or on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
#: Bytes of text taken at once; longer texts are cut between words.
SLICE = 1 << 20


def byte_class(word_bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the byte that each stands for."""
    is_word = np.zeros(256, dtype=bool)
    is_word[list(word_bytes)] = True
    value = np.arange(256, dtype=np.uint8)
    if lower:
        value[65:91] += 32
    return is_word, value


#: Everything but ASCII white space, as in ``[^\x20\x09-\x0D]+``.
SPACED = byte_class([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D], lower=False)
#: The same with A-Z in lower case.
SPACED_LOWER = (SPACED[0], byte_class([], lower=True)[1])
#: Letters, digits and all beyond ASCII, A-Z in lower case.
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)], lower=True)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    up, down = np.full(n + 1, base, dtype=_U), np.full(n + 1, pow(base, -1, 1 << 64), dtype=_U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a string column; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.string()), False
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
    """Hash of the bytes from each start to its end."""
    up, down = _powers(base, max(SLICE, 1 << int(len(data)).bit_length()))
    run = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(_U))


def _cuts(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SLICE that end between documents, or between words of a long one; no word is cut."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + SLICE, end)
        if to < end:
            k = int(offsets[np.searchsorted(offsets, to, side="right") - 1])
            if k > at:
                to = k
            else:
                stop = int(offsets[np.searchsorted(offsets, to, side="left")])  # where this row ends
                while to < stop and is_word[data[to]]:
                    more = np.flatnonzero(~is_word[data[to : min(to + 65536, stop)]])
                    to = to + int(more[0]) if len(more) else min(to + 65536, stop)
        yield at, to
        at = to


def words(column: pa.Array, kind: tuple[np.ndarray, np.ndarray], hashes: int = 1, spans: bool = False):
    """Hashes of all words of a column in order, and where each row's words end.

    Returns ([hash arrays], ends of rows in words); with ``spans`` also the words'
    start and end bytes within the column's data.
    """
    is_word, value = kind
    data, offsets = buffers(column)
    found: list[list[np.ndarray]] = [[] for _ in range(hashes)]
    all_starts, all_ends = [], []
    for a, b in _cuts(data, offsets, is_word):
        part = data[a:b]
        inside = is_word[part]
        first = np.zeros(b - a + 1, dtype=bool)  # a row starts here
        rows = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b, side="right")] - a
        first[rows] = True
        first[0] = True
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after_first = first[1:].copy()
        after_first[-1] = True
        ends = np.flatnonzero(inside & (~after | after_first)) + 1
        low = value[part]
        for k in range(hashes):
            found[k].append(byte_hash(low, starts, ends, _BASES[k]))
        all_starts.append(starts + a)
        all_ends.append(ends + a)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    starts = join(all_starts, np.int64)
    row_ends = np.searchsorted(starts, offsets[1:], side="left")
    # An empty row at the end of the data has the same offset as its neighbour, hence "left".
    out = [join(f, _U) for f in found]
    if spans:
        return out, row_ends, starts, join(all_ends, np.int64)
    return out, row_ends


def windows(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each n values in a row (of len(h) - n + 1 windows; rows are not looked at)."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=_U)
    base = pow(0xD6E8FEB86659FD93 + 2 * seed, 1, 1 << 64)
    total = np.zeros(size, dtype=_U)
    factor = 1
    for k in range(n):
        factor = factor * base % (1 << 64)
        total += h[k : k + size] * _U(factor)
    return mix(total)
