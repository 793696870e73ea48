"""Token ids of a corpus in shards, each a wavelet matrix in one compressed file row.

A wavelet matrix holds a sequence as one bit plane for each bit of an id. Going
down, ids whose bit is 0 are moved to the front, in order. With counts of ones
before every block of bits, the id at a place, the number of occurrences of an
id, and the place of its k-th occurrence take one step for each plane.

Rows are dealt in ranges of ids and written in that order; a shard holds whole
documents, about ``SHARD_TOKENS`` of their ids. Its place in the corpus is found
by prefix sums, first inside each partition, then over partitions.

Null and empty texts are the end id alone. Repeated rows are written each. An
empty table gives no shard.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancylens.llm.arrays import texts
from vacancylens.llm.frames import ready_for_python, small_side
from vacancylens.llm.tokens import TokenizerFile, encoder, ids_crc32

SHARD_TOKENS = 1 << 18
_MAGIC = b"WVM1"
_HEADER = struct.Struct("<4sQBQ")  # magic, ids, planes, documents
#: Bits between two counts of ones.
_SPAN = 512


class WaveletMatrix:
    """A sequence of ids as bit planes, with counts for rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ones = []
        for plane in planes:
            words = np.zeros(-(-n // _SPAN) * (_SPAN // 8), np.uint8)
            words[: len(plane)] = plane
            counts = np.bitwise_count(words.reshape(-1, _SPAN // 8)).sum(axis=1, dtype=np.int64)
            self.ones.append(np.concatenate([[0], np.cumsum(counts)]))

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            one = (now >> now.dtype.type(b)) & now.dtype.type(1) != 0
            planes.append(np.packbits(one, bitorder="little"))
            front = now[~one]
            zeros.append(len(front))
            now = np.concatenate([front, now[one]])
        return cls(len(ids), planes, zeros)

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3] >> (at & 7)) & 1

    def _rank1(self, level: int, at: int) -> int:
        """Ones before a place of a plane."""
        block = at // _SPAN
        part = self.planes[level][block * (_SPAN // 8) : at >> 3]
        count = int(self.ones[level][block]) + int(np.bitwise_count(part).sum())
        return count + (int(self.planes[level][at >> 3] & ((1 << (at & 7)) - 1)).bit_count() if at & 7 else 0)

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, at)
            ones = self._rank1(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _span(self, token: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of an id before ``stop`` are after the last plane."""
        lo, hi = 0, stop
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if token >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, stop: int) -> int:
        """Occurrences of an id before a place."""
        lo, hi = self._span(token, stop)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def occurrences(self, token: int) -> np.ndarray:
        """All places of an id, ascending."""
        lo, hi = self._span(token, self.n)
        at = np.arange(lo, hi)
        for level in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            one = token >> (len(self.planes) - 1 - level) & 1
            at = np.flatnonzero(bits if one else ~bits)[at - (self.zeros[level] if one else 0)]
        return at

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0) of an id."""
        lo, hi = self._span(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            at = self._select_bit(level, at - (self.zeros[level] if one else 0), bool(one))
        return at

    def _select_bit(self, level: int, k: int, one: bool) -> int:
        ones = self.ones[level]
        before = ones if one else np.arange(len(ones)) * _SPAN - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * (_SPAN // 8) : (block + 1) * (_SPAN // 8)], bitorder="little")
        return block * _SPAN + int(np.flatnonzero(part == one)[k - before[block]])

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up."""
        bits = len(self.planes)
        now = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[~one] = now[: self.zeros[level]]
            up[one] = now[self.zeros[level] :] | now.dtype.type(1 << (bits - 1 - level))
            now = up
        return now.astype(np.uint32)


def to_bytes(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, bits: int | None = None) -> bytes:
    """One shard: header, documents, zeros of each plane and planes, compressed."""
    if bits is None:  # as wide as the largest id, which the file says
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    matrix = WaveletMatrix.of(ids, bits)
    parts = [
        _HEADER.pack(_MAGIC, len(ids), bits, len(lengths)),
        doc_ids.astype("<i8").tobytes(),
        lengths.astype("<u8").tobytes(),
        np.array(matrix.zeros, "<u8").tobytes(),
        *(plane.tobytes() for plane in matrix.planes),
    ]
    raw = b"".join(parts)
    return struct.pack("<Q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def from_bytes(blob: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """The matrix, document ids and lengths of a shard."""
    (size,) = struct.unpack_from("<Q", blob)
    raw = pa.decompress(memoryview(blob)[8:], size, codec="zstd", asbytes=True)
    magic, n, bits, documents = _HEADER.unpack_from(raw)
    if magic != _MAGIC:
        raise ValueError("not a shard")
    at = _HEADER.size
    doc_ids = np.frombuffer(raw, "<i8", documents, at)
    lengths = np.frombuffer(raw, "<u8", documents, at + 8 * documents).astype(np.int64)
    at += 16 * documents
    zeros = np.frombuffer(raw, "<u8", bits, at).astype(np.int64).tolist()
    at += 8 * bits
    width = -(-n // 8)
    planes = [np.frombuffer(raw, np.uint8, width, at + k * width) for k in range(bits)]
    return WaveletMatrix(n, planes, zeros), doc_ids, lengths


SHARD_SCHEMA = "part long, shard int, first_doc long, n_docs long, n_tokens long, bytes binary"


def write_shards(
    docs: DataFrame, path: str, file: TokenizerFile, end_id: int = 0, bits: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write all texts in ascending id order; every row of the files is a shard.

    A shard has as many planes as its largest id has bits; with a stated number of
    ``bits`` an id that needs more fails the run. Rows without an id can't be placed and fail the run.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ready_for_python(docs.sparkSession)

    def shards(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, n = TaskContext.get().partitionId(), 0, 0
        owners: list[int] = []
        held: list[np.ndarray] = []
        end = np.array([end_id], np.uint32)

        def finish() -> pa.RecordBatch:
            blob = to_bytes(np.concatenate(held), np.array(owners, np.int64), np.array([len(h) for h in held]), bits)
            values = [part, shard, owners[0], len(owners), n, blob]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in stream:
            ids = batch.column(0).to_pylist()
            for chunk in texts(batch.column(1)):
                tokens, first = encoder(file).encode(chunk)
                for row in range(len(chunk)):
                    own = np.concatenate([tokens[first[row] : first[row + 1]], end])
                    if held and n + len(own) > SHARD_TOKENS:
                        yield finish()
                        shard, n, owners, held = shard + 1, 0, [], []
                    if ids[chunk.lo + row] is None:
                        raise ValueError("a document without an id has no place in the order")
                    owners.append(ids[chunk.lo + row])
                    held.append(own)
                    n += len(own)
        if held:
            yield finish()

    dealt = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the ids of all documents before each."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("part", "shard", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    # One row for each partition of the writing job.
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("shard")), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(parts, "part")
    starts = starts.select("part", "shard", (F.col("base") + F.col("inside")).alias("start"))
    return shards.join(small_side(starts, shards.count()), ["part", "shard"])


def _over_shards(shards: DataFrame, function, schema: str, columns: list[str]) -> DataFrame:
    ready_for_python(shards.sparkSession)

    def each(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pydict(dict(zip(columns, function(start, blob), strict=True)))

    return shards.select("start", "bytes").mapInArrow(each, schema)


def documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""

    def read(start: int, blob: bytes) -> list[pa.Array]:
        matrix, doc_ids, lengths = from_bytes(blob)
        ids = matrix.decode()
        ends = np.cumsum(lengths)
        sums = [ids_crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        return [pa.array(doc_ids), pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())]

    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return _over_shards(shards, read, "doc_id long, start long, n_tokens long, ids_crc32 long", columns)


def token_ids(shards: DataFrame) -> DataFrame:
    """``doc_id, ids`` of every document in the files."""

    def read(start: int, blob: bytes) -> list[pa.Array]:
        matrix, doc_ids, lengths = from_bytes(blob)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return [pa.array(doc_ids), pa.ListArray.from_arrays(offsets, pa.array(matrix.decode().astype(np.int32)))]

    return _over_shards(shards, read, "doc_id long, ids array<int>", ["doc_id", "ids"])


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """``doc_id, position`` (in the whole corpus) of every occurrence of an id."""

    def read(start: int, blob: bytes) -> list[pa.Array]:
        matrix, doc_ids, lengths = from_bytes(blob)
        at = matrix.occurrences(token)
        return [pa.array(doc_ids[np.searchsorted(np.cumsum(lengths), at, side="right")]), pa.array(start + at)]

    return _over_shards(shards, read, "doc_id long, position long", ["doc_id", "position"])


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """One row ``n``: occurrences of an id in all shards."""

    def read(start: int, blob: bytes) -> list[pa.Array]:
        return [pa.array([from_bytes(blob)[0].count(token)])]

    return _over_shards(shards, read, "n long", ["n"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
