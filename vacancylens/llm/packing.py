"""Packing of token sequences: best fit, then swaps between underfull bins.

Texts are encoded and cut into pieces of at most ``capacity`` tokens. Pieces are
packed in blocks of ``BLOCK`` of them, each in one task: largest first into the
fullest bin that has room, then a local search. An underfull bin is filled further
by a move of one or two documents from another one, or an exchange of one for one,
two for one or one for two. Documents and pairs of all bins lie sorted by length,
so partners that fit a bin's room are looked up and all of them are seen. A step
has to raise the sum of squared fills; the search ends when no step does or when no
bin can be saved. Bins of all blocks that are still underfull go into the next
level, which packs their pieces together again, until a level saves no sequence.

Null and empty texts are the end token alone. Repeated rows are packed each.
Sequences and places are found by order of the stored rows, so a task that runs
again packs alike. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylens.llm.arrays import Texts
from vacancylens.llm.frames import list_column, over_texts, ready_for_python, stored
from vacancylens.llm.tokens import TokenizerFile, encoder, ids_crc32

CAPACITY = 4096
BLOCK = 8192
#: A bin with more room than this part of the capacity is packed again.
OPEN_PART = 1 / 128
#: Partners that are compared together.
COMPARED = 1 << 20


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices, largest first into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable").tolist()
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    bins: list[list[int]] = []
    for k in order:
        size = int(lengths[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(k)
        else:
            room, b = capacity, len(bins)
            bins.append([k])
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


class _Bins:
    """Bins of documents while they are searched."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int) -> None:
        self.capacity, self.lengths = capacity, lengths.astype(np.int64)
        self.members = [list(b) for b in bins]
        self.of = np.empty(len(lengths), np.int64)
        for b, own in enumerate(bins):
            self.of[own] = b
        self.fill = np.bincount(self.of, self.lengths, len(bins)).astype(np.int64)

    def underfull(self) -> list[int]:
        """Bins with documents and room, the emptiest first."""
        open_ = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        return open_[np.argsort(self.fill[open_], kind="stable")].tolist()

    def _some(self, b: int) -> list[int]:
        """A bin's documents, no more than two of a length: others make no other sums.

        A bin has few different lengths (their sum is at most the capacity).
        """
        seen: dict[int, int] = {}
        out = []
        for k in self.members[b]:
            size = int(self.lengths[k])
            seen[size] = seen.get(size, 0) + 1
            if seen[size] <= 2:
                out.append(k)
        return out

    def _groups(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and pairs of documents, of a bin as rows of two; -1 for none."""
        some = np.array(self._some(b), np.int64)
        i, j = np.triu_indices(len(some), 1)
        return np.stack([some, np.full(len(some), -1)], axis=1), np.stack([some[i], some[j]], axis=1)

    def size(self, groups: np.ndarray) -> np.ndarray:
        return np.where(groups >= 0, self.lengths[groups], 0).sum(axis=1)

    def sorted_groups(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Single documents and pairs of all underfull bins, ``(groups, sizes)`` by size."""
        found = [self._groups(b) for b in self.underfull()]
        out = []
        for kind in (0, 1):
            groups = np.concatenate([np.zeros((0, 2), np.int64), *(f[kind] for f in found)])
            sizes = self.size(groups)
            order = np.argsort(sizes, kind="stable")
            out.append((groups[order], sizes[order]))
        return out

    def best_step(self, target: int, partners: list[tuple[np.ndarray, np.ndarray]]) -> tuple | None:
        """``(give, take, gain)`` that fills a bin furthest and raises the sum of squares."""
        room = self.capacity - int(self.fill[target])
        none = np.full((1, 2), -1)
        singles, pairs = self._groups(target)
        best, chosen = 0, None
        # One document for none, one or two of the bin; two for none or one.
        for (groups, sizes), own in zip(partners, ([none, singles, pairs], [none, singles]), strict=True):
            takes = np.concatenate(own)
            taken = self.size(takes)
            lo, hi = np.searchsorted(sizes, taken + best, "right"), np.searchsorted(sizes, taken + room, "right")
            counts = np.maximum(hi - lo, 0)
            ends = np.cumsum(counts)
            at = 0
            while at < len(takes):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED, "right")))
                own_counts = counts[at:stop]
                take = np.repeat(np.arange(at, stop), own_counts)
                before = np.cumsum(own_counts) - own_counts
                give = np.arange(len(take)) - np.repeat(before - lo[at:stop], own_counts)
                gain = sizes[give] - taken[take]
                first, second = groups[give, 0], groups[give, 1]
                donor = self.of[first]
                fits = (donor != target) & (self.fill[donor] < self.capacity) & (self.fill[target] + gain > self.fill[donor])
                fits &= (second < 0) | (self.of[second] == donor)  # moved since the pairs were listed
                gain = np.where(fits, gain, 0)
                if len(gain) and gain.max() > best:
                    k = int(gain.argmax())
                    best, chosen = int(gain[k]), (groups[give[k]], takes[take[k]])
                at = stop
            if best == room:
                break
        return None if chosen is None else (*chosen, best)

    def apply(self, target: int, give: np.ndarray, take: np.ndarray, gain: int) -> int:
        """Make a step; the bin that gave."""
        donor = int(self.of[give[0]])
        for group, here, there in ((give, donor, target), (take, target, donor)):
            for k in group[group >= 0].tolist():
                self.members[here].remove(k)
                self.members[there].append(k)
                self.of[k] = there
        self.fill[target] += gain
        self.fill[donor] -= gain
        return donor


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over the underfull bins until no step is left or no bin can be saved."""
    state = _Bins(bins, lengths, capacity)
    least = math.ceil(int(state.fill.sum()) / capacity)
    count, changed = int((state.fill > 0).sum()), True
    while changed and count > least:
        changed = False
        partners = state.sorted_groups()
        for target in state.underfull():
            while 0 < state.fill[target] < capacity and count > least:
                step = state.best_step(target, partners)
                if step is None:
                    break
                donor = state.apply(target, *step)
                count -= not state.fill[donor]
                changed = True
    return [b for b in state.members if b]


def pack_block(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return improve(best_fit(lengths, capacity), lengths, capacity)


def pieces(
    docs: DataFrame, file: TokenizerFile, end_id: int, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every row's tokens."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if keep_ids else ""

    def cut(chunk: Texts, rows: pa.RecordBatch) -> dict:
        ids, first = encoder(file).encode(chunk)
        owner, number, start, length, sums, parts = [], [], [], [], [], []
        end = np.array([end_id], np.uint32)
        for row in range(len(chunk)):
            own = np.concatenate([ids[first[row] : first[row + 1]], end])
            for k, lo in enumerate(range(0, len(own), capacity)):
                part = own[lo : lo + capacity]
                owner.append(row)
                number.append(k)
                start.append(lo)
                length.append(len(part))
                sums.append(ids_crc32(part))
                if keep_ids:
                    parts.append(part.astype(np.int32))
        out = {"doc_id": rows.column(0).take(pa.array(owner)), "piece": number, "start": start, "length": length, "ids_crc32": sums}
        return out | ({"ids": list_column(parts, pa.int32())} if keep_ids else {})

    return over_texts(narrow, cut, schema)


def _pack_level(rows: DataFrame, level: int, capacity: int) -> DataFrame:
    """``rows`` with ``sequence_id, offset, room`` of the block that a task sees them in."""
    ready_for_python(rows.sparkSession)
    places = "sequence_id long, offset long, room int, block long"
    schema = StructType(rows.schema.fields + StructType.fromDDL(places).fields)

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (level << 56) | (TaskContext.get().partitionId() << 34)
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in stream:
            for lo in range(0, len(batch), BLOCK):
                part = batch.slice(lo, BLOCK)
                if n and n + len(part) > BLOCK:
                    done, at = finish(held, at)
                    yield from done
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if n:
            yield from finish(held, at)[0]

    def finish(held: list[pa.RecordBatch], at: int) -> tuple[list[pa.RecordBatch], int]:
        table = pa.Table.from_batches(held)
        lengths = table.column("length").to_numpy()
        sequence, offset, room = (np.zeros(len(lengths), np.int64) for _ in range(3))
        packed = pack_block(lengths, capacity)
        for b, members in enumerate(packed):
            ends = np.cumsum(lengths[members])
            sequence[members] = at + b
            offset[members] = ends - lengths[members]
            room[members] = capacity - ends[-1]
        table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        table = table.append_column("room", pa.array(room.astype(np.int32)))
        return table.append_column("block", pa.array(np.full(len(lengths), at))).to_batches(), at + len(packed)

    return rows.mapInArrow(pack, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows with a ``length`` of 1 to ``capacity``, with ``sequence_id`` and ``offset``."""
    columns, is_open = cut.columns, F.col("room") > int(capacity * OPEN_PART)
    state = [F.countDistinct("block"), F.count_distinct(F.when(is_open, F.col("sequence_id"))), F.count_if(is_open), F.count_distinct("sequence_id")]
    packed = stored(_pack_level(cut, 0, capacity), "packed")
    blocks, n_open, n_rows, _ = packed.agg(*state).first()
    done, level = [], 0
    while blocks > 1 and n_open:
        level += 1
        rows = packed.filter(is_open).select(*columns).repartition(math.ceil(n_rows / BLOCK))
        again = stored(_pack_level(rows, level, capacity), "packed")
        blocks, now_open, n_rows, n_now = again.agg(*state).first()
        if n_now >= n_open:  # nothing saved: the bins stay as they are
            break
        done.append(packed.filter(~is_open))
        packed, n_open = again, now_open
    out = packed
    for more in done:
        out = out.unionByName(more)
    return out.select(*columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, file: TokenizerFile, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents in as few sequences of ``capacity`` tokens as found."""
    return pack(stored(pieces(docs, file, end_id, capacity), "pieces"), capacity)
