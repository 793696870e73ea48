"""Benchmark passages in documents, by spaced seeds.

Words are runs of letters and digits, A-Z as a-z, so marks and line breaks don't
count; in scripts that put no space between words each character is a word. A
mask picks some of the words in a window and ignores the others; its hash finds a
passage although an ignored word was replaced. The masks leave out every one
of 8 words and every two of 10 at some place, which is all that may differ (a
passage of more words holds such a part), so no passage is missed. Hashes of all windows
of the benchmark are joined with those of all documents. Before the join a
bitmap of fixed size, made from the benchmark's hashes, drops nearly all windows
of the documents; it may keep a window in vain but never drops a match.

Around each hit both word sequences are laid over one another at the hit's
distance. A document holds a passage if ``WINDOW`` words (all, if the item has
fewer) in a row agree in ``SHARE`` percent or more. The result has a row for each
document and item with that.

Items of fewer than ``LEAST_WORDS`` words are no passage that could be told from
common speech; a document holds one if a line of it or its whole text is the item,
found by the hash of all words. Null and empty texts hold nothing. Repeated rows of a
document give one row. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LETTER, LOWER, Texts, Words, byte_set, complement, flagged, mix, windows, words
from vacancylens.llm.frames import list_column, over_texts, small_side, stored, without

#: The fewest masks of six words that miss nothing (found by search, counted in the tests).
MASKS = ("1111011", "10101111", "11011101", "110010111", "111100011")
LEAST_WORDS = 8
WINDOW, SHARE = 13, 80
#: Bits of the bitmap: 2 MiB whatever the size of the benchmark.
BITMAP_BITS = 1 << 24

_WORD = bytes(a | b for a, b in zip(LETTER, byte_set("0123456789"), strict=True))
#: Characters that are words, and marks that are none, beyond ASCII (first and last, ascending).
_SINGLE = ((0x0E00, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
_MARKS = ((0x0E4F, 0x0E4F), (0x0E5A, 0x0E5B), (0x104A, 0x104F), (0x17D4, 0x17DA), (0x2000, 0x206F), (0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFE10, 0xFE1F), (0xFE30, 0xFE4F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_IN_LINE = complement(byte_set("\n"))
_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _among(points: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    first, last = np.array(ranges).T
    k = np.searchsorted(first, points, side="right") - 1
    return (k >= 0) & (points <= last[k])


def words_of(chunk: Texts) -> Words:
    """The words of the texts; only long characters need a look at each."""
    data = chunk.data
    at = np.flatnonzero(data >= 0xE0)
    if not len(at):
        return words(chunk, LOWER, _WORD)
    end = len(data) - 1
    a, b, c, d = (data[np.minimum(at + k, end)].astype(np.int32) for k in range(4))
    three = (a & 15) << 12 | (b & 63) << 6 | c & 63
    points = np.where(a < 0xF0, three, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63)
    size = np.where(a < 0xF0, 3, 4)
    inside = flagged(data, _WORD).copy()
    mark = _among(points, _MARKS)
    for k in range(3):
        inside[np.minimum(at[mark] + k, end)] = False
    single = _among(points, _SINGLE) & ~mark
    breaks = np.concatenate([at[single], np.minimum(at[single] + size[single], end + 1)])
    return words(chunk, LOWER, inside, breaks=breaks)


def seeds(hashes: np.ndarray, mask: int) -> np.ndarray:
    """Hash of the mask's words from each place on; texts are not told apart."""
    places = [k for k, c in enumerate(MASKS[mask]) if c == "1"]
    n = len(hashes) - len(MASKS[mask]) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, mask + 1, np.uint64)
    for k in places:
        total += hashes[k : k + n] * _PLACE[k]
    return mix(total)


def _whole_seeds(found: Words, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the spans of bytes that hold 1 to ``LEAST_WORDS`` - 1 words."""
    first, last = np.searchsorted(found.starts, starts), np.searchsorted(found.starts, ends)
    at, seed = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in range(1, LEAST_WORDS):
        own = first[last - first == n]
        at.append(own)
        seed.append(mix(windows(found.hashes, n)[own] + _PLACE[n]) if len(own) else seed[0])
    return np.concatenate(at), np.concatenate(seed)


def _short_lines(chunk: Texts, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """The same for lines and whole texts; a text of one line gives one."""
    lines = words(chunk, solid=_IN_LINE)
    starts = np.concatenate([lines.starts, chunk.offsets[:-1]])
    ends = np.concatenate([lines.ends, chunk.offsets[1:]])
    at, seed = _whole_seeds(found, starts, ends)
    kept = np.unique(np.stack([at.astype(np.uint64), seed]), axis=1) if len(at) else np.zeros((2, 0), np.uint64)
    return kept[0].astype(np.int64), kept[1]


def _inside(first: np.ndarray, n: int, span: int) -> np.ndarray:
    """Whether a window from each of n places stays in its text."""
    ends = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + span <= ends


def _item_rows(chunk: Texts, rows: pa.RecordBatch) -> dict:
    found = words_of(chunk)
    return {
        "item_id": rows.column(0),
        "words": list_column([found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)], pa.int64()),
    }


def _item_seeds(chunk: Texts, rows: pa.RecordBatch) -> dict:
    found = words_of(chunk)
    owner, at, seed = [], [], []
    of = np.repeat(np.arange(len(chunk)), found.counts)
    for mask, pattern in enumerate(MASKS):
        values = seeds(found.hashes, mask)
        keep = np.flatnonzero(_inside(found.first, len(values), len(pattern)))
        keep = keep[found.counts[of[keep]] >= LEAST_WORDS]
        owner.append(of[keep])
        at.append(keep - found.first[of[keep]])
        seed.append(values[keep])
    whole, hashes = _whole_seeds(found, chunk.offsets[:-1], chunk.offsets[1:])
    owner.append(of[whole])
    at.append(np.zeros(len(whole), np.int64))
    seed.append(hashes)
    return {
        "item_id": rows.column(0).take(pa.array(np.concatenate(owner))),
        "at": np.concatenate(at),
        "seed": np.concatenate(seed),
    }


def _bitmap(of_items: DataFrame) -> np.ndarray:
    """One bit for each value of the low bits of a seed; fixed size, built by Spark."""
    place = F.col("seed").bitwiseAND(BITMAP_BITS - 1) + 1
    parts = (
        of_items.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in parts:
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        lo = (row["bucket"] - 1) * len(own)
        out[lo : lo + len(own)] = own
    return out


def _windows_alike(item: np.ndarray, doc: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """First and last word of a document that agree with the item at a distance, and how many do."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    width = min(WINDOW, len(item))
    if hi - lo < width:
        return None
    same = item[lo:hi] == doc[shift + lo : shift + hi]
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(100 * (sums[width:] - sums[:-width]) >= SHARE * width)
    if not len(good):
        return None
    a, b = int(good[0]), int(good[-1]) + width
    return shift + lo + a, shift + lo + b, int(sums[b] - sums[a])


def _verify(chunk: Texts, rows: pa.RecordBatch) -> dict:
    found = words_of(chunk)
    out: dict[str, list] = {"doc_id": [], "item_id": [], "start": [], "n_words": [], "n_same": [], "item_words": []}
    ids, items = rows.column("doc_id").to_pylist(), rows.column("item_id").to_pylist()
    for row in range(len(chunk)):
        doc = found.hashes[found.first[row] : found.first[row + 1]]
        item = np.array(rows.column("words")[row].as_py(), np.int64).view(np.uint64)
        spans = [_windows_alike(item, doc, shift) for shift in rows.column("shifts")[row].as_py()]
        best = max((s for s in spans if s is not None), key=lambda s: (s[2], -s[0]), default=None)
        if best is not None:
            values = ids[row], items[row], best[0], best[1] - best[0], best[2], len(item)
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
    return out


def _prepared(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(docs, items, seeds of items)`` under fixed names, without ids and texts that are null."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    narrow = narrow.filter("doc_id is not null and text is not null")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = items.filter("item_id is not null and text is not null")
    of_items = over_texts(items, _item_seeds, "item_id long, at long, seed long")
    # A passage that repeats inside an item is found from its first place.
    of_items = stored(of_items.groupBy("item_id", "seed").agg(F.min("at").alias("at")), "seeds")
    return narrow, items, of_items


def _hits(narrow: DataFrame, of_items: DataFrame) -> DataFrame:
    """``doc_id, doc_at, seed`` of the documents' windows that the bitmap lets through."""
    bitmap = narrow.sparkSession.sparkContext.broadcast(_bitmap(of_items))

    def hits(chunk: Texts, rows: pa.RecordBatch) -> dict:
        found = words_of(chunk)
        bits = bitmap.value
        owner, at, seed = [], [], []
        of = np.repeat(np.arange(len(chunk)), found.counts)

        def in_bitmap(values: np.ndarray) -> np.ndarray:
            low = values & np.uint64(BITMAP_BITS - 1)
            return np.flatnonzero(bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1)

        whole, hashes = _short_lines(chunk, found)
        keep = in_bitmap(hashes)
        owner.append(of[whole[keep]])
        at.append(whole[keep] - found.first[of[whole[keep]]])
        seed.append(hashes[keep])
        for mask, pattern in enumerate(MASKS):
            values = seeds(found.hashes, mask)
            keep = in_bitmap(values)
            keep = keep[keep + len(pattern) <= found.first[of[keep] + 1]]
            owner.append(of[keep])
            at.append(keep - found.first[of[keep]])
            seed.append(values[keep])
        return {
            "doc_id": rows.column(0).take(pa.array(np.concatenate(owner))),
            "doc_at": np.concatenate(at),
            "seed": np.concatenate(seed),
        }

    return over_texts(narrow, hits, "doc_id long, doc_at long, seed long")


def _confirmed(narrow: DataFrame, items: DataFrame, met: DataFrame) -> DataFrame:
    """Of hits joined with seeds of items (``doc_id, doc_at, item_id, at``) what the texts bear out."""
    shifts = met.select("doc_id", "item_id", (F.col("doc_at") - F.col("at")).alias("shift"))
    near = stored(shifts.groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts")), "hits")
    ids = stored(near.select("doc_id").distinct(), "hit_docs")
    texts = narrow.join(small_side(ids, ids.count()), "doc_id", "left_semi")
    tokens = over_texts(items, _item_rows, "item_id long, words array<long>").distinct()
    rows = near.join(tokens, "item_id").join(texts, "doc_id").select("doc_id", "item_id", "shifts", "words", "text")
    schema = "doc_id long, item_id long, start long, n_words long, n_same long, item_words long"
    spans = over_texts(rows, _verify, schema)
    # Rows that share an id may hold the item in different places.
    best = F.struct("n_same", (-F.col("start")).alias("back"), "start", "n_words", "item_words")
    longest = spans.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
    return longest.select("doc_id", "item_id", "best.start", "best.n_words", "best.n_same", "best.item_words")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, n_words, n_same, item_words``: passages that documents hold.

    ``start`` and ``n_words`` are the words of the document at the longest
    agreement, ``n_same`` of which are the item's.
    """
    narrow, items, of_items = _prepared(docs, benchmark, id_col, text_col, item_col, item_text_col)
    return _confirmed(narrow, items, _hits(narrow, of_items).join(of_items, "seed"))


def contaminated_ids(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id`` of the documents with a row in :func:`contaminated`, each once.

    First every hit meets one item that has its seed, so a passage that many items
    share makes one pair for a document. Only documents for which that shows nothing
    meet the others.
    """
    narrow, items, of_items = _prepared(docs, benchmark, id_col, text_col, item_col, item_text_col)
    found = stored(_hits(narrow, of_items), "seed_hits")
    one = of_items.groupBy("seed").agg(F.min(F.struct("item_id", "at")).alias("one")).select("seed", "one.*")
    first = stored(_confirmed(narrow, items, found.join(one, "seed")).select("doc_id").distinct(), "contaminated")
    rest = found.join(first, "doc_id", "left_anti").join(of_items, "seed")
    return first.unionByName(_confirmed(narrow, items, rest).select("doc_id").distinct())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark."""
    return without(docs, contaminated_ids(docs, benchmark))
