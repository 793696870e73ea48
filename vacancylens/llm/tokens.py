"""Token ids of whole texts by a tokenizer file of the tokenizers library.

A text is cut where the tokenizer's own pattern always begins anew, so the ids of
the text are those of its units one after another. In each chunk the distinct
units are encoded once, and a bounded store keeps the ids of units for the
chunks and tasks that the same Python worker sees later.
"""

from __future__ import annotations

import itertools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from vacancylens.llm.arrays import LOWER, Texts, mapped, span_hashes

#: Units whose ids a worker keeps; beyond it the store begins anew.
STORED_UNITS = 1_200_000
#: New units that are encoded as one text.
JOINED = 128
#: New units that are sorted on their own, so the large store is sorted seldom.
SMALL_TIER = 60_000

# Kinds of bytes, one bit each.
_SPACE, _GRAPHIC, _LEAD, _LATER, _LETTER, _MARK = (1 << k for k in range(6))


def _kind(byte: int) -> int:
    if byte in (0x20, *range(0x09, 0x0E)):
        return _SPACE
    if 0x80 <= byte < 0xC0:
        return _LATER
    if 0xC3 <= byte < 0xE0:  # of two-byte characters from U+00C0 on, none of which is a space
        return _LEAD
    if not 0x21 <= byte < 0x7F:
        return 0
    character = chr(byte)
    if character.isalpha():
        return _GRAPHIC | _LETTER
    # With an apostrophe a pattern may go on into letters.
    return _GRAPHIC if character.isdigit() or character == "'" else _GRAPHIC | _MARK


_KINDS = bytes(map(_kind, range(256)))


def _turns(kinds: np.ndarray) -> np.ndarray:
    """Where ASCII letters meet ASCII marks: no pattern goes across."""
    here, before = kinds[1:] & (_LETTER | _MARK), kinds[:-1] & (_LETTER | _MARK)
    out = np.zeros(len(kinds), dtype=bool)
    np.equal(here ^ before, _LETTER | _MARK, out=out[1:])
    return out


def byte_level_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that cover the texts, for patterns like `` ?letters| ?digits| ?marks|spaces``.

    A unit begins with each lone ASCII space (or other ASCII white space) that
    stands between two characters that surely aren't white space.
    """
    n = len(data)
    kinds = mapped(data, _KINDS)
    begin = _turns(kinds)
    alone = (kinds[1:-1] & _SPACE) & ((kinds[2:] & (_GRAPHIC | _LEAD)) != 0)
    solid_before = (kinds[:-2] & _GRAPHIC) != 0
    solid_before[1:] |= ((kinds[:-3] & _LEAD) != 0) & ((kinds[1:-2] & _LATER) != 0)
    begin[1:-1] |= (alone != 0) & solid_before
    begin[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], n)


def word_level_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs without ASCII white space, for patterns that drop white space."""
    kinds = mapped(data, _KINDS)
    inside = (kinds & _SPACE) == 0
    fresh = np.ones(len(data) + 1, dtype=bool)
    np.logical_not(inside[:-1], out=fresh[1:-1])
    fresh[:-1] |= _turns(kinds)
    fresh[offsets[:-1]] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    fresh[:-1] |= ~inside
    return starts, np.flatnonzero(inside & fresh[1:]) + 1


@dataclass(frozen=True)
class TokenizerFile:
    """A tokenizer file that executors find at ``path``, and how its texts may be cut.

    ``units``: ``byte`` for byte-level vocabularies of exact text, ``word`` for
    vocabularies of lower-cased words that drop white space.
    """

    path: str
    units: str


class Encoder:
    """Encodes chunks of texts; holds the ids of the units it has seen."""

    def __init__(self, file: TokenizerFile):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file.path)
        self.tokenizer.encode_special_tokens = True
        self.cut, self.fold = (byte_level_units, None) if file.units == "byte" else (word_level_units, LOWER)
        # A line feed ends every byte-level token; a digit is a word of its own.
        self.separator, self.plain = ("\n", re.compile(r" ?\S+")) if file.units == "byte" else (" 0 ", re.compile(r"[^\s0]+"))
        (self.separator_id,) = self.tokenizer.encode(self.separator, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.tiers = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))] * 2  # ascending hashes and their entries
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each unit, -1 if it has none."""
        out = np.full(len(hashes), -1, np.int32)
        for keys, entries in self.tiers:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                same = keys[at] == hashes
                out[same] = entries[at[same]]
        return out

    def _add(self, hashes: np.ndarray) -> None:
        """Merge new hashes into the small tier, and that into the large one when it is full."""
        keys = np.concatenate([self.tiers[1][0], hashes])
        entries = np.concatenate([self.tiers[1][1], np.arange(len(self.length) - len(hashes), len(self.length), dtype=np.int32)])
        large = self.tiers[0]
        if len(keys) > SMALL_TIER:
            keys, entries = np.concatenate([large[0], keys]), np.concatenate([large[1], entries])
            large = (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        order = np.argsort(keys, kind="stable")
        tier = (keys[order], entries[order])
        self.tiers = [large, tier] if len(large[0]) or len(keys) <= SMALL_TIER else [tier, large]

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit; plain ones are encoded many at a time.

        Between two units stands a separator that is always a token of its own
        and that no plain unit contains.
        """
        plain = [k for k, u in enumerate(units) if self.plain.fullmatch(u)]
        out: list[list[int]] = [[]] * len(units)
        odd = set(range(len(units))) - set(plain)
        joined = [plain[lo : lo + JOINED] for lo in range(0, len(plain), JOINED)]
        texts = [self.separator.join(units[k] for k in part) for part in joined]
        for part, got in zip(joined, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = got.ids
            cuts = [-1, *(k for k, i in enumerate(ids) if i == self.separator_id), len(ids)]
            if len(cuts) != len(part) + 1:
                odd.update(part)
                continue
            for k, lo, hi in zip(part, cuts[:-1], cuts[1:], strict=True):
                out[k] = ids[lo + 1 : hi]
        alone = sorted(odd)
        for k, got in zip(alone, self.tokenizer.encode_batch_fast([units[k] for k in alone], add_special_tokens=False), strict=True):
            out[k] = got.ids
        return out

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        got = self._encode_units(units)
        length = np.fromiter(map(len, got), np.int32, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(length.sum()))
        begin = len(self.ids) + np.cumsum(length, dtype=np.int64) - length
        self.begin = np.concatenate([self.begin, begin])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids])
        self._add(hashes)

    def encode(self, chunk: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and where each text's ids begin."""
        data, offsets = chunk.data, chunk.offsets
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, ends = self.cut(data, offsets)
        coded = pa.array(span_hashes(data, starts, ends, self.fold)).dictionary_encode()
        distinct = coded.dictionary.to_numpy()
        which = coded.indices.to_numpy()
        entry = self._find(distinct)
        if (entry < 0).any():
            if len(self.length) + len(distinct) > STORED_UNITS:
                self._forget()
                entry[:] = -1
            new = np.flatnonzero(entry < 0)
            sample = np.empty(len(distinct), np.int64)
            sample[which] = np.arange(len(which))
            raw, spans = data.tobytes(), zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            entry[new] = np.arange(len(self.length) - len(new), len(self.length))
        place = entry[which]
        length = self.length[place]
        total = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        shift = np.repeat(self.begin[place] - total[:-1], length)
        shift += np.arange(total[-1])
        first = np.searchsorted(starts, offsets)
        return self.ids[shift], total[first]


_encoders: dict[TokenizerFile, Encoder] = {}


def encoder(file: TokenizerFile) -> Encoder:
    """The worker's encoder of a file, made once."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
