"""The best documents for each item of a benchmark, ranked by shared terms.

1. Terms of a set of items are a vocabulary. Documents become blocks: sizes, and
   for each term of the vocabulary its documents and occurrences (a chunk of texts
   at a time, whole texts). Blocks are stored; counts over all of them give weights.
2. In a block every term has a bitmap of its documents and a greatest part of a
   score. For an item, terms that even together stay below the score to beat are
   set aside; the union of the other bitmaps holds all documents that may matter.
3. The bits of all the item's terms are laid side by side for these documents:
   the presence mask of each. Documents are grouped by mask. A mask's sum of
   greatest parts bounds the score of its documents; masks are evaluated from the
   highest bound down until the next one is below the score to beat.
4. A task keeps the best of each item over its blocks and returns these; Spark
   ranks them. No row is made for a pair of item and document but for those.

Items are worked on in sets of bounded size, so a large benchmark takes several
passes. Terms are known by 64-bit hashes.

Documents without an id and documents without a term are no hits; those without an
id count for nothing. A null text has no terms. Rows that share an id are ranked
each by its own text. Items that share an id are one, with the terms of all. Items
without id or terms have no hits. Empty tables give empty ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LOWER, Texts, byte_set, words
from vacancylens.llm.frames import list_column, over_texts, ready_for_python, stored

TOP = 50
#: Distinct terms of items (with repeats over items) that are worked on in one pass.
SET_TERMS = 500_000
#: Documents of a block in memory, and how many are scored together.
BLOCK_DOCS, BATCH_DOCS = 16_384, 64

_TERM = byte_set("0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0x100))


def _item_terms(chunk: Texts, rows: pa.RecordBatch) -> dict:
    found = words(chunk, LOWER, _TERM)
    sets = [np.unique(found.hashes[a:b]) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    return {"item_id": rows.column(0), "terms": list_column(sets, pa.int64())}


@dataclass
class Items:
    """Some items: their ids, their terms as places in a sorted vocabulary."""

    ids: list[int]
    terms: list[np.ndarray]
    vocabulary: np.ndarray


def _items(rows: list) -> Items:
    vocabulary = np.unique(np.concatenate([np.array(r["terms"], np.int64).view(np.uint64) for r in rows]))
    places = [np.searchsorted(vocabulary, np.array(r["terms"], np.int64).view(np.uint64)) for r in rows]
    return Items([r["item_id"] for r in rows], [np.sort(p) for p in places], vocabulary)


def _sets_of_items(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """All items with terms, a bounded number of terms at a time."""
    given = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null")
    listed = over_texts(given, _item_terms, "item_id long, terms array<long>")
    apart = listed.select("item_id", F.explode("terms").alias("term"))
    terms = stored(apart.groupBy("item_id").agg(F.collect_set("term").alias("terms")), "item_terms")
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_sets = -(-total // SET_TERMS)
    for k in range(n_sets):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(n_sets)) == k).collect()
        if rows:
            yield _items(rows)


# ---- blocks -----------------------------------------------------------------

_BLOCK = "docs array<long>, sizes array<int>, terms array<int>, ends array<int>, rows array<int>, counts array<int>"


def _block_of(vocabulary) -> Callable[[Texts, pa.RecordBatch], dict]:
    """Documents with terms, and postings of the vocabulary: term, document's row, occurrences."""

    def run(chunk: Texts, rows: pa.RecordBatch) -> dict:
        found, known = words(chunk, LOWER, _TERM), vocabulary.value
        at = np.searchsorted(known, found.hashes)
        at[at == len(known)] = 0
        hit = np.flatnonzero(known[at] == found.hashes)
        with_terms = found.counts > 0
        place = np.cumsum(with_terms) - 1
        of = np.repeat(np.arange(len(chunk)), found.counts)[hit]
        pairs, n = np.unique(at[hit] * np.int64(len(chunk)) + of, return_counts=True)
        term, row = pairs // len(chunk), place[pairs % len(chunk)]
        terms, first = np.unique(term, return_index=True)
        parts = {
            "docs": rows.column(0).to_numpy(zero_copy_only=False)[with_terms], "sizes": found.counts[with_terms],
            "terms": terms, "ends": np.append(first[1:], len(term))[: len(terms)], "rows": row, "counts": n,
        }
        return {name: list_column([v.astype(np.int64)], pa.int64() if name == "docs" else pa.int32()) for name, v in parts.items()}

    return run


class Block:
    """Postings of some documents, by term."""

    def __init__(self, parts: list[dict], weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.docs = np.concatenate([p["docs"] for p in parts])
        sizes = np.concatenate([p["sizes"] for p in parts]).astype(np.int64)
        shift = np.cumsum([0, *(len(p["docs"]) for p in parts)])
        term = np.concatenate([np.repeat(p["terms"], np.diff(p["ends"], prepend=0)) for p in parts])
        row = np.concatenate([p["rows"] + s for p, s in zip(parts, shift, strict=False)]).astype(np.int64)
        count = np.concatenate([p["counts"] for p in parts]).astype(np.int64)
        order = np.argsort(term, kind="stable")  # rows ascend within a term
        self.rows, count = row[order], count[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.bounds = np.append(first, len(term))
        length = 100 - 50 + (50 * sizes * n_docs) // n_terms
        part = (1_000_000_000 * count) // (1000 * count + 20 * length[self.rows])
        owner = np.repeat(self.terms, np.diff(self.bounds))
        #: What each posting adds to its document's score, and the most any of a term's adds.
        self.parts = weights[owner] * part
        self.most = np.maximum.reduceat(self.parts, first) if len(first) else np.zeros(0, np.int64)
        self.bitmaps = np.zeros((len(self.terms), -(-len(self.docs) // 8)), np.uint8)
        for k in range(len(self.terms)):
            present = np.zeros(len(self.docs), np.uint8)
            present[self.rows[self.bounds[k] : self.bounds[k + 1]]] = 1
            self.bitmaps[k] = np.packbits(present)

    def here(self, terms: np.ndarray) -> np.ndarray:
        """Which of some terms the block has, as places in it."""
        if not len(self.terms):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at[self.terms[at] == terms]

    def scores(self, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of some documents (ascending rows) by the terms at some places."""
        total = np.zeros(len(docs), np.int64)
        for k in at.tolist():
            lo, hi = self.bounds[k], self.bounds[k + 1]
            rows = self.rows[lo:hi]
            found = np.minimum(np.searchsorted(rows, docs), len(rows) - 1)
            total += np.where(rows[found] == docs, self.parts[lo:hi][found], 0)
        return total


class Best:
    """The highest scores of one item so far; equal ones by ascending id."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def to_beat(self) -> int:
        """A document with less is not among the best; with as much it may be."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        keep = scores >= self.to_beat
        scores, docs = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.docs, docs[keep]])
        order = np.lexsort((docs, -scores))[: self.top]
        self.scores, self.docs = scores[order], docs[order]


def masks(block: Block, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(distinct, group)``: distinct presence masks (a bit for each term) and each row's."""
    bits = np.unpackbits(block.bitmaps[at], axis=1, count=len(block.docs))[:, rows]
    packed = np.ascontiguousarray(np.packbits(bits, axis=0).T)
    wide = np.zeros((len(rows), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    keys = wide.view(np.uint64)
    group = np.zeros(len(rows), np.int64)
    for column in keys.T:  # 64 terms at a time
        _, own = np.unique(column, return_inverse=True)
        _, group = np.unique(group * (int(own.max()) + 1) + own, return_inverse=True)
    first = np.zeros(int(group.max()) + 1, np.int64)
    first[group] = np.arange(len(rows))
    return bits[:, first].T, group


def search_block(block: Block, terms: np.ndarray, best: Best) -> None:
    """Add the block's documents that may be among the best of an item."""
    at = block.here(terms)
    at = at[np.argsort(block.most[at], kind="stable")]
    reach = np.cumsum(block.most[at])
    # Terms that together stay below the score to beat lift no document by themselves.
    essential = at[np.searchsorted(reach, best.to_beat) :]
    if not len(essential):
        return
    union = np.bitwise_or.reduce(block.bitmaps[essential], axis=0)
    rows = np.flatnonzero(np.unpackbits(union, count=len(block.docs)))
    distinct, group = masks(block, at, rows)
    bounds = distinct.astype(np.int64) @ block.most[at]
    ranked = np.argsort(-bounds, kind="stable")
    place = np.empty(len(ranked), np.int64)
    place[ranked] = np.arange(len(ranked))
    order = np.argsort(place[group], kind="stable")  # documents by their mask's place
    bound_of = bounds[group[order]]
    lo = 0
    while lo < len(order) and bound_of[lo] >= best.to_beat:
        hi = min(lo + BATCH_DOCS, len(order))
        docs = np.sort(rows[order[lo:hi]])
        best.add(block.scores(at, docs), block.docs[docs])
        lo = hi


def _search_tasks(items, weights, n_docs: int, n_terms: int, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(top) for _ in items.value.ids]
        held: list[dict] = []

        def work() -> None:
            block = Block(held, weights.value, n_docs, n_terms)
            for terms, best in zip(items.value.terms, found, strict=True):
                search_block(block, terms, best)

        for batch in stream:
            for k in range(len(batch)):
                held.append({name: batch.column(name)[k].values.to_numpy(zero_copy_only=False) for name in batch.schema.names})
                if sum(len(p["docs"]) for p in held) >= BLOCK_DOCS:
                    work()
                    held = []
        if held:
            work()
        for item, best in zip(items.value.ids, found, strict=True):
            columns = [np.full(len(best.docs), item, np.int64), best.docs, best.scores]
            if len(best.docs):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _weights(blocks: DataFrame, size: int, n_docs: int) -> np.ndarray:
    """Each term's weight; the vocabulary is bounded, so its counts fit the driver."""
    first = F.concat(F.array(F.lit(0)), "ends")
    counts = F.zip_with("ends", F.slice(first, F.lit(1), F.size("ends")), lambda a, b: (a - b).cast("long"))
    listed = blocks.select(F.inline(F.arrays_zip("terms", counts.alias("n"))).alias("term", "n"))
    held = np.zeros(size, np.int64)
    for row in listed.groupBy("term").agg(F.sum("n").alias("n")).collect():
        held[row["term"]] = row["n"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def _search_set(docs: DataFrame, items: Items, top: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(items.vocabulary)
    blocks = stored(over_texts(docs, _block_of(vocabulary), _BLOCK), "blocks")
    total = blocks.agg(F.sum(F.size("docs")).alias("docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 1
    weights = context.broadcast(_weights(blocks, len(items.vocabulary), n_docs))
    ready_for_python(docs.sparkSession)
    tasks = _search_tasks(context.broadcast(items), weights, n_docs, n_terms or 1, top)
    return blocks.mapInArrow(tasks, "item_id long, doc_id long, score long")


def search(
    docs: DataFrame, benchmark: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    parts = [_search_set(narrow, items, top) for items in _sets_of_items(benchmark, item_col, item_text_col)]
    hits = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for part in parts:
        hits = hits.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
