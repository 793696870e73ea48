"""Phrases that occur together, mined with stripes.

A stripe is the counter of one prefix: next word -> occurrences. Words are known
by 64-bit hashes, prefixes by 128 bits; a language's words have hashes of its own.

1. Words are counted. The text becomes sequences of frequent words' hashes, with 0
   where a piece ends or a rarer word stands; no phrase to be found holds one.
2. Level by level, every occurrence of a frequent prefix of k - 1 words adds its
   next word to the prefix's stripe, or ``OTHER`` (a break, or a word with which the
   last k - 1 words are not frequent). Tasks build stripes for some hundred thousand
   entries at a time and hand them on by bucket, the leading bits of the prefix: a
   row holds all stripes of a bucket as bytes, so Spark moves few rows, whatever the
   number of prefixes. Equal prefixes of a bucket are then merged elementwise.
3. A merged stripe holds all that is asked: its sum is the prefix's total, its
   entries of ``least`` or more are the phrases of k words, its greatest entry says
   whether a longer phrase to the right subsumes the prefix. The same entries, read
   by the phrase's last k - 1 words, say so for the left.
4. Cuts look up the totals of both parts; scores are exact decimals.

Which prefixes may be frequent is asked of a bitmap whose size is bounded; if it
says yes too often, more is counted, never less. Prefixes with more than one in
``HOT_SHARE`` of all words (at most so many) have their stripes in segments of the
next word, each in a bucket of its own, so no task merges a whole one. Nothing else
is limited.

Null texts have no words, a null language is ``und``. Repeated rows count each time.
Empty texts and tables give no phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LOWER, Texts, byte_set, complement, flagged, mapped, mix, span_hashes, words
from vacancylens.llm.frames import over_texts, ready_for_python, stored

MOST_WORDS, LEAST, TOP = 5, 100, 2000
#: Occurrences that a task counts together, entries that it holds, and that it hands on together.
OCCURRENCES, HELD_ENTRIES, ENTRIES = 200_000, 700_000, 50_000
#: Bytes of texts, sequences or stripes in a batch; worker and executor hold some copies of each.
BATCH_BYTES = 1 << 19
#: A prefix with more than this part of all words has its stripe in segments.
HOT_SHARE, SEGMENT_BITS = 4096, 6
#: Bits of a bucket: so many at least and at most (a sort by 16 bits takes one pass), and words for each.
LEAST_BITS, MOST_BUCKET_BITS, BUCKET_WORDS = 12, 16, 1 << 17
#: Parts in which a language's phrases are ordered before the best of all are.
RANKED_PARTS = 128
#: Words of a row of the stored sequences, if a break allows. Spark's readers and writers of
#: Parquet hold some thousand rows or a hundred at least, so rows are short.
ROW_WORDS = 256
#: Bits of a bitmap for each frequent phrase, and the most of one bitmap (16 MiB).
BITS_EACH, MOST_BITS = 16, 1 << 27

_PIECE_END = byte_set(".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)
_IN_WORD = complement(byte_set(".,;:!?", 0x20, *range(0x09, 0x0E)))
OTHER = np.uint64(0)
_FIRST, _SECOND, _TURN = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x5851F42D4C957F2D)


# ---- words ------------------------------------------------------------------


def _of_languages(rows: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct languages of some rows, each row's, and a hash of each."""
    coded = rows.column("lang").dictionary_encode()
    names = coded.dictionary.to_pylist()
    data = [n.encode() for n in names]
    ends = np.cumsum([len(d) + 1 for d in data], dtype=np.int64)
    flat = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return names, coded.indices.to_numpy(zero_copy_only=False), mix(span_hashes(flat, starts, ends - 1) ^ _TURN) if names else np.zeros(0, np.uint64)


def _keys_and_breaks(chunk: Texts, rows: pa.RecordBatch) -> tuple:
    """The words of some texts with their language's keys, and where pieces begin."""
    found = words(chunk, LOWER, _IN_WORD)
    names, code, tongue = _of_languages(rows)
    of = np.repeat(code, found.counts)
    keys = mix(found.hashes * _FIRST + tongue[of]) if len(of) else np.zeros(0, np.uint64)
    keys[keys == OTHER] = 1
    ended = np.concatenate([[0], np.cumsum(flagged(chunk.data, _PIECE_END))])[found.starts]
    begins = np.ones(len(keys), bool)
    begins[1:] = ended[1:] != ended[:-1]
    begins[found.first[:-1][found.first[:-1] < len(keys)]] = True
    return found, names, of, keys, begins


def _chunk_words(chunk: Texts, rows: pa.RecordBatch) -> dict:
    found, names, of, keys, _ = _keys_and_breaks(chunk, rows)
    distinct, at, n = np.unique(keys, return_index=True, return_counts=True)
    folded = mapped(chunk.data, LOWER).tobytes()
    spans = zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)
    return {
        "lang": pa.array(names, pa.string()).take(pa.array(of[at], pa.int64())),
        "word": [folded[a:b].decode("utf-8", "replace") for a, b in spans],
        "n": n,
    }


def _word_keys(chunk: Texts, rows: pa.RecordBatch) -> dict:
    """Words, one a row, with the keys that :func:`_keys_and_breaks` gives them."""
    _, code, tongue = _of_languages(rows)
    keys = mix(span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:]) * _FIRST + tongue[code])
    keys[keys == OTHER] = 1
    return {"lang": rows.column("lang"), "word": rows.column("word"), "f": rows.column("f"), "a": keys, "b": _second(keys)}


def _bits_for(phrases: int) -> int:
    """A power of two, so that a key's low bits are its place."""
    return min(MOST_BITS, max(1 << 16, 1 << (BITS_EACH * phrases).bit_length()))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """One bit for the low bits of each ``a``; of bounded size, built by Spark."""
    bits = _bits_for(keys.count())
    place = F.col("a").bitwiseAND(bits - 1) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        out[(row["bucket"] - 1) * len(own) :][: len(own)] = own
    return out


def _held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1).view(bool)


# ---- stripes ----------------------------------------------------------------


def _as_bytes(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Slices of an array as one binary column: a value of Spark's is then a slice and not a number."""
    offsets = ((cuts - cuts[0]) * values.itemsize).astype(np.int32)
    data = values[cuts[0] : cuts[-1]].copy()  # else the last batch would hold all entries until the next one comes
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _from_bytes(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of :func:`_as_bytes`, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat.view(kind), np.diff(offsets) // np.dtype(kind).itemsize


def _second(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _TURN)


def _longer(a: np.ndarray, b: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of phrases with one word more."""
    return mix(a * _FIRST + word), mix(b * _SECOND + word)


def _next_words(words_: np.ndarray, k: int, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefixes of k - 1 words that may be frequent, and the word after each or ``OTHER``."""
    a, b, whole = words_, _second(words_), words_ != OTHER
    for j in range(1, k - 1):
        a, b = _longer(a[:-1], b[:-1], words_[j:])
        whole = whole[:-1] & (words_[j:] != OTHER)
    passed = whole & _held(bitmap, a)
    at = np.flatnonzero(passed)
    following = np.zeros(len(at), np.uint64)
    # The phrase's last k - 1 words have to be a possible prefix too.
    more = np.flatnonzero(at + 1 < len(passed))
    more = more[passed[at[more] + 1]]
    following[more] = words_[at[more] + k - 1]
    return a[at], b[at], following


def _entries(parts: list[list]) -> list[np.ndarray]:
    """Equal ``(a, b, word)`` summed, entries of a prefix together and by word; empties ``parts``.

    A column at a time, so that little more than the entries themselves is held.
    """
    columns = []
    for c in range(4):
        columns.append(np.concatenate([p[c] for p in parts]))
        for p in parts:
            p[c] = None
    parts.clear()
    key = columns[2] >> np.uint64(32)
    key |= columns[0] & np.uint64(0xFFFFFFFF00000000)
    order = np.argsort(key)
    del key
    for c in range(4):
        columns[c] = columns[c][order]
    del order
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in range(3):
        new[1:] |= columns[c][1:] != columns[c][:-1]
    at = np.flatnonzero(new)
    del new
    if len(at):
        columns[3] = np.add.reduceat(columns[3], at, dtype=np.int32)
    for c in range(3):
        columns[c] = columns[c][at]
    return columns


def _bucket_bits(n_words: int) -> int:
    return min(MOST_BUCKET_BITS, max(LEAST_BITS, (n_words // BUCKET_WORDS).bit_length()))


def _buckets(a: np.ndarray, word: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each entry: leading bits of its prefix, of a hot one (ascending ``hot``) with the segment."""
    shift = np.uint64(64 - bits)
    out = (a >> shift).astype(np.uint16)
    if len(hot):
        of_hot = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, a), len(hot) - 1)] == a)
        segment = word[of_hot] >> np.uint64(64 - SEGMENT_BITS)
        out[of_hot] = mix(a[of_hot] + segment + np.uint64(1)) >> shift
    return out


_STRIPES = "bucket int, a binary, b binary, lengths binary, words binary, counts binary"


def _stripes(entries: list[np.ndarray], hot: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Entries as a row for each bucket: its prefixes, their numbers of entries, and these; empties ``entries``."""
    bucket = _buckets(entries[0], entries[2], hot, bits)
    if len(hot):
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        for c in range(4):
            entries[c] = entries[c][order]
        del order
    a, b, word, n = entries
    entries.clear()
    new, fresh = np.zeros(len(a), bool), np.zeros(len(a), bool)
    new[:1] = fresh[:1] = True
    fresh[1:] = bucket[1:] != bucket[:-1]
    new[1:] = fresh[1:]
    for column in (a, b):
        new[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(a))).astype(np.int32)
    rows = np.flatnonzero(fresh[starts])  # the first prefix of each bucket
    prefixes, cuts, bucket = np.append(rows, len(starts)), np.append(starts[rows], len(a)), bucket[starts[rows]]
    a, b = a[starts], b[starts]
    del new, fresh, starts
    ends = np.unique(np.searchsorted(cuts, np.arange(ENTRIES, len(word), ENTRIES)))
    for lo, hi in zip([0, *ends], [*ends, len(rows)], strict=True):
        if lo == hi:
            continue
        of_prefixes, of_entries = prefixes[lo : hi + 1], cuts[lo : hi + 1]
        columns = [pa.array(bucket[lo:hi].astype(np.int32)), *(_as_bytes(v, of_prefixes) for v in (a, b, lengths)), *(_as_bytes(v, of_entries) for v in (word, n))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "a", "b", "lengths", "words", "counts"])


def _count_stripes(k: int, bitmap, hot, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n_seen, held, n_held = [], 0, [], 0
        for batch in stream:  # every row of it ends with a break
            flat, _ = _from_bytes(batch.column(0), np.uint64)
            if len(flat) < k:
                continue
            a, b, word = _next_words(flat, k, bitmap.value)
            # The second half of a word's key follows from the first and need not be held.
            seen.append([a, b if k > 2 else np.zeros(len(a), np.uint8), word, np.ones(len(a), np.int32)])
            n_seen += len(a)
            del a, b, word
            if n_seen < OCCURRENCES:
                continue
            held.append(_entries(seen))
            n_held, n_seen = n_held + len(held[-1][0]), 0
            if n_held > HELD_ENTRIES:
                held.append(_entries(held))
                n_held = len(held[0][0])
                if n_held > HELD_ENTRIES // 2:  # little was equal: what was stays, if it is not much
                    often = held[0][3] > 1
                    n_held = int(often.sum())
                    if n_held > HELD_ENTRIES // 4:
                        often[:], n_held = False, 0
                    kept, rest = [c[often] for c in held[0]], [c[~often] for c in held.pop()]
                    held = [kept] if n_held else []
                    del kept, often
                    yield from _stripes(rest, hot.value, bits)
        if n_seen or n_held:
            held += seen
            seen = []
            yield from _stripes(_entries(held), hot.value, bits)

    return run


def _summed(group: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counters of several prefixes (ascending groups) merged elementwise."""
    order = np.lexsort((word, group))
    group, word, n = group[order], word[order], n[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(new)
    return group[at], word[at], np.add.reduceat(n, at) if len(at) else n


_MERGED = "a long, b long, total long, best long, words array<long>, counts array<long>, next_a array<long>, next_b array<long>"


def _merge_stripes(k: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of stripes, sorted by bucket, to one row for each prefix and bucket.

    The bucket at hand is held merged, so memory is that of a batch and of one
    bucket's entries.
    """
    names = [c.split()[0] for c in _MERGED.split(", ")]

    def finish(a: np.ndarray, b: np.ndarray, group: np.ndarray, word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        first = np.searchsorted(group, np.arange(len(a)))
        total = np.add.reduceat(n, first)
        phrase = word != OTHER
        best = np.maximum.reduceat(np.where(phrase, n, 0), first)
        kept = np.flatnonzero(phrase & (n >= least))
        cuts = np.searchsorted(group[kept], np.arange(len(a) + 1)).astype(np.int32)
        longer = _longer(a[group[kept]], b[group[kept]], word[kept])
        lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(v.view(np.int64))) for v in (word[kept], n[kept], *longer)]
        flat = [pa.array(v.view(np.int64)) for v in (a, b)]
        return pa.RecordBatch.from_arrays([*flat, pa.array(total), pa.array(best), *lists], names=names)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last bucket so far: of its prefixes, the bucket, the key and the number of entries; the entries.
        last = [np.zeros(0, kind) for kind in (np.int32, np.uint64, np.uint64, np.int64, np.uint64, np.int64)]
        for batch in stream:
            if not len(batch):
                continue
            (a, prefixes), (lengths, _), (word, _), (n, _) = (
                _from_bytes(batch.column(c), kind) for c, kind in (("a", np.uint64), ("lengths", np.int32), ("words", np.uint64), ("counts", np.int32))
            )
            b = _from_bytes(batch.column("b"), np.uint64)[0] if k > 2 else _second(a)
            bucket = np.repeat(batch.column("bucket").to_numpy(), prefixes)
            bucket, a, b, lengths, word, n = (np.concatenate(v) for v in zip(last, (bucket, a, b, lengths, word, n), strict=True))
            order = np.lexsort((b, a, bucket))
            bucket, a, b = bucket[order], a[order], b[order]
            new = np.ones(len(a), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            of = np.empty(len(a), np.int64)
            of[order] = np.cumsum(new) - 1
            group, word, n = _summed(np.repeat(of, lengths), word, n)
            bucket, a, b = bucket[new], a[new], b[new]
            whole = int(np.searchsorted(bucket, bucket[-1]))  # prefixes of buckets that are over
            cut = int(np.searchsorted(group, whole))
            if whole:
                yield finish(a[:whole], b[:whole], group[:cut], word[:cut], n[:cut])
            last = [bucket[whole:], a[whole:], b[whole:], np.bincount(group[cut:] - whole), word[cut:], n[cut:]]
        _, a, b, lengths, word, n = last
        if len(a):
            yield finish(a, b, np.repeat(np.arange(len(a)), lengths), word, n)

    return run


def _in_small_batches(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """:func:`stored`, for functions in Python that need not see much at a time."""
    ready_for_python(df.sparkSession, BATCH_BYTES)
    out = stored(df, purpose, codec)
    ready_for_python(df.sparkSession)
    return out


def _merged(sequences: DataFrame, k: int, frequent: DataFrame, n_words: int, least: int) -> DataFrame:
    """The stripes of all prefixes of k - 1 words."""
    context = sequences.sparkSession.sparkContext
    bitmap = context.broadcast(_bitmap(frequent))
    # No more than HOT_SHARE prefixes can have so many occurrences.
    hot = [r["a"] for r in frequent.where(F.col("f") > n_words // HOT_SHARE).select("a").collect()]
    hot = context.broadcast(np.sort(np.array(hot, np.int64).view(np.uint64)))
    counted = sequences.mapInArrow(_count_stripes(k, bitmap, hot, _bucket_bits(n_words)), _STRIPES)
    return _in_small_batches(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge_stripes(k, least), _MERGED), f"stripes{k}")


# ---- phrases ----------------------------------------------------------------


def _score() -> Column:
    """floor(1000 a n / (l r)); decimals of 38 digits hold counts up to 10**17."""
    wide = {c: f"cast({c} as decimal(19, 0))" for c in "anlr"}
    return F.expr(f"cast(1000 * {wide['a']} * {wide['n']} as decimal(38, 0)) div cast({wide['l']} * {wide['r']} as decimal(38, 0))")


def _words_of(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where("text is not null")


def _sequence_rows(keys: np.ndarray, begins: np.ndarray, bitmap: np.ndarray) -> list[np.ndarray]:
    """Keys with a break before each piece, for each rarer word, and at the end of each row."""
    keys = np.where(_held(bitmap, keys), keys, OTHER)
    keys = np.append(np.insert(keys, np.flatnonzero(begins), OTHER), OTHER)
    kept = keys != OTHER
    kept[1:] |= keys[:-1] != OTHER  # breaks that follow one another are one
    keys = keys[kept]
    breaks = np.flatnonzero(keys == OTHER)
    wanted = np.searchsorted(breaks, np.arange(ROW_WORDS, len(keys), ROW_WORDS))
    return [row for row in np.split(keys, np.unique(breaks[wanted] + 1)) if len(row) > 1]


def _mined(docs: DataFrame, least: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, totals, languages)``.

    ``phrases``: ``lang, words, phrase, f`` of all phrases of 1 to ``MOST_WORDS``
    words with ``f >= least``; ``words`` are keys. ``totals``: ``words, total, best``
    of those with fewer words: the sum and the greatest entry of their stripes.
    ``languages``: ``lang, n``.
    """
    spark, narrow = docs.sparkSession, _words_of(docs, lang_col, text_col)
    counted = over_texts(narrow, _chunk_words, "lang string, word string, n long")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    keyed = over_texts(counted.where(F.col("f") >= least), _word_keys, "lang string, word string, f long, a long, b long", column="word")
    one = stored(keyed.select("lang", F.array("a").alias("words"), F.col("word").alias("phrase"), "f", "a", "b"), "phrases1")
    bitmap = spark.sparkContext.broadcast(_bitmap(one))

    def sequence(chunk: Texts, rows: pa.RecordBatch) -> dict:
        _, _, _, keys, begins = _keys_and_breaks(chunk, rows)
        rows = [np.zeros(0, np.uint64), *_sequence_rows(keys, begins, bitmap.value)]
        return {"keys": _as_bytes(np.concatenate(rows), np.cumsum([len(r) for r in rows]))}

    sequences = _in_small_batches(over_texts(narrow, sequence, "keys binary"), "sequences", "zstd")
    n_words = counted.agg(F.sum("f")).first()[0] or 0
    last_words = one.select("lang", F.col("a").alias("word"), F.col("phrase").alias("last"))
    level, phrases = one, one
    none = F.lit(0).cast("long")
    totals = one.where(F.lit(False)).select("words", none.alias("total"), none.alias("best"))  # rows of the driver's would start more workers
    for k in range(2, MOST_WORDS + 1):
        if level.isEmpty():
            break
        stripes = _merged(sequences, k, level, n_words, least)
        sums = stripes.groupBy("a", "b").agg(F.sum("total").alias("total"), F.max("best").alias("best"))
        totals = totals.unionByName(sums.join(level, ["a", "b"]).select("words", "total", "best"))
        entries = F.arrays_zip("words", "counts", "next_a", "next_b")
        entries = stripes.select("a", "b", F.inline(entries).alias("word", "f", "next_a", "next_b"))
        grown = entries.join(level.drop("f"), ["a", "b"]).join(last_words, ["lang", "word"])
        words_, phrase = F.concat("words", F.array("word")), F.concat_ws(" ", "phrase", "last")
        columns = [words_.alias("words"), phrase.alias("phrase"), "f", F.col("next_a").alias("a"), F.col("next_b").alias("b")]
        level = stored(grown.select("lang", *columns), f"phrases{k}")
        phrases = phrases.unionByName(level)
    return phrases.drop("a", "b"), totals, counted.groupBy("lang").agg(F.sum("f").alias("n"))


def _worst_cuts(phrases: DataFrame, totals: DataFrame, languages: DataFrame) -> DataFrame:
    """``lang, words, phrase, a, n`` and the ``cut`` of each phrase with the lowest score."""
    size = F.size("words")
    cuts = phrases.where(size > 1).select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    lefts = totals.select(F.col("words").alias("left"), F.col("total").alias("l"))
    rights = totals.select(F.col("words").alias("right"), F.col("total").alias("r"))
    scored = cuts.join(lefts, "left").join(rights, "right").join(languages, "lang").withColumn("score", _score())
    return scored.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))


def _subsumed(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``words, longer``: the most frequent phrase with one word more at either end.

    If any longer phrase is as frequent as one it holds, so is one with a word more.
    """
    size = F.size("words")
    at_left = phrases.where(size > 2).select(F.slice("words", F.lit(2), size - 1).alias("words"), F.col("f").alias("longer"))
    at_right = totals.where(size > 1).select("words", F.col("best").alias("longer"))
    return at_left.unionByName(at_right).groupBy("words").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases.

    The score of a phrase is that of its worst cut; phrases inside a longer one that
    is as frequent are left out.
    """
    phrases, totals, languages = _mined(docs, least, lang_col, text_col)
    scored = _worst_cuts(phrases, totals, languages).join(_subsumed(phrases, totals), "words", "left")
    kept = scored.where(F.coalesce("longer", F.lit(0)) < F.col("a"))
    order = [F.desc("cut.score"), F.desc("a"), "phrase"]
    # The best of a language are among the best of its parts, so no task orders a whole one.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("words"), F.lit(RANKED_PARTS))).orderBy(*order)
    ranked = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
