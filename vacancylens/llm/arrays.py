"""Texts as byte arrays: words, hashes and shingles of an Arrow batch at once.

All functions work on UTF-8 bytes. The separators they know are ASCII, and no
byte of a longer character is ASCII, so cutting bytes is cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; a longer text goes alone.
CHUNK = 2 << 20
#: Bytes whose 64-bit prefix sums are held at a time.
BLOCK = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def byte_set(*members: int | str) -> bytes:
    """A table of flags, 1 for the bytes given as numbers or as characters."""
    flags = bytearray(256)
    for m in members:
        for b in [m] if isinstance(m, int) else m.encode():
            flags[b] = 1
    return bytes(flags)


def complement(flags: bytes) -> bytes:
    return bytes(1 - f for f in flags)


def mapped(data: np.ndarray, table: bytes) -> np.ndarray:
    """Each byte's entry of a table of 256."""
    return np.frombuffer(data.tobytes().translate(table), np.uint8)


def flagged(data: np.ndarray, flags: bytes) -> np.ndarray:
    return mapped(data, flags).view(bool)


#: A-Z like a-z, for hashing; None hashes exact bytes.
LOWER = bytes(range(256)).lower()
#: Bytes of words that end at white space (0x20, 0x09 to 0x0D).
NOT_SPACE = complement(byte_set(0x20, *range(0x09, 0x0E)))
#: Bytes of words made of letters: ASCII letters and all of longer characters.
_ASCII_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LETTER = byte_set(_ASCII_LETTERS)
LETTER = byte_set(_ASCII_LETTERS, *range(128, 256))

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Texts:
    """Some rows of a batch: their numbers and the bytes of one text column."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo

    def raw(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def text(self, row: int) -> str:
        return self.raw(row).decode("utf-8", "replace")


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets


def texts(column: pa.Array, limit: int = CHUNK) -> Iterator[Texts]:
    """The rows of a string column in chunks of at most ``limit`` bytes or one row."""
    data, offsets = string_buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Texts(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of some texts: places, hashes, and where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    prefixes: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _long_span(data: np.ndarray) -> np.uint64:
    """Hash of one span that is longer than a block."""
    power, _ = _power_tables(BLOCK)
    total = 0
    for lo in range(0, len(data), BLOCK):
        part = data[lo : lo + BLOCK]
        own = int(((part + np.uint64(1)) * power[: len(part)]).sum(dtype=np.uint64))
        total += own * pow(int(_BASE), lo, 1 << 64)
    return np.uint64(total & ((1 << 64) - 1))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bytes | None = None) -> np.ndarray:
    """64-bit hashes of ascending, disjoint spans, after ``fold`` of their bytes.

    Prefix sums over a block of bytes at a time serve all its spans.
    """
    power, inverse = _power_tables(BLOCK + 1)
    if fold is not None:
        data = mapped(data, fold)
    out = np.empty(len(starts), np.uint64)
    sums = np.zeros(BLOCK + 1, np.uint64)
    k = 0
    while k < len(starts):
        lo = int(starts[k])
        stop = int(np.searchsorted(ends, lo + BLOCK, side="right"))
        if stop <= k:
            out[k] = _long_span(data[lo : int(ends[k])])
            k += 1
            continue
        hi = int(ends[stop - 1])
        values = data[lo:hi].astype(np.uint64)
        values += np.uint64(1)
        values *= power[: hi - lo]
        np.cumsum(values, out=sums[1 : hi - lo + 1])
        at = starts[k:stop] - lo
        out[k:stop] = (sums[ends[k:stop] - lo] - sums[at]) * inverse[at]
        k = stop
    return mix(out)


def words(
    chunk: Texts, fold: bytes | None = None, solid: bytes | np.ndarray = NOT_SPACE, prefix: int = 0, breaks: np.ndarray | None = None
) -> Words:
    """Maximal runs of ``solid`` bytes, hashed after ``fold`` of their bytes.

    Equal words have equal hashes; different words have different ones but for
    chances of 2**-64. With ``prefix``, the first so many bytes of each word are
    hashed as well. ``solid`` may be a flag for each byte of the chunk, and no word
    goes on at the bytes ``breaks``.
    """
    data, offsets = chunk.data, chunk.offsets
    inside = flagged(data, solid) if isinstance(solid, bytes) else solid
    heads = offsets[:-1][offsets[:-1] < len(data)]
    fresh = np.ones(len(data) + 1, dtype=bool)  # no word goes on here from the byte before
    np.logical_not(inside[:-1], out=fresh[1:-1])
    fresh[heads] = True
    if breaks is not None:
        fresh[breaks] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    fresh[:-1] |= ~inside
    ends = np.flatnonzero(inside & fresh[1:]) + 1
    first = np.searchsorted(starts, offsets)
    hashes = span_hashes(data, starts, ends, fold)
    prefixes = span_hashes(data, starts, np.minimum(ends, starts + prefix), fold) if prefix else None
    return Words(starts, ends, hashes, first, prefixes)


_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values, whatever text they are in."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= _STEP
        total += hashes[j : j + n]
    return mix(total)


def short_sequence(hashes: np.ndarray) -> np.uint64:
    """Hash of all values of a sequence too short for a window."""
    total = np.array([len(hashes)], np.uint64) << np.uint64(56)
    for h in hashes:
        total = total * _STEP + h
    return mix(total ^ np.uint64(0x5851F42D4C957F2D))[0]


def shingle_sets(found: Words, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles.

    A text of fewer words has its whole sequence as the only one, a text
    without words none.
    """
    all_windows = windows(found.hashes, k)
    sets = []
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if hi - lo >= k:
            sets.append(np.unique(all_windows[lo : hi - k + 1]))
        elif hi > lo:
            sets.append(np.array([short_sequence(found.hashes[lo:hi])]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
