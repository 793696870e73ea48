import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tricky

from vacancylens.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, top):
    f, n = {}, Counter()
    for text, lang in rows:
        count = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 6):
                count.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        kept = []
        candidates = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, least, top):
    docs = spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string").repartition(3)
    out = collocations.collocations(docs, least, top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in out.dtypes} == {"string", "bigint"}
    return sorted(tuple(r) for r in out.collect())


def texts(rng, rows, vocabulary):
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " - ", ".", "\x0b"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    made = []
    for _ in range(rows):
        words = rng.choices(vocabulary, weights, k=rng.randrange(60))
        text = "".join(w + rng.choice(marks) for w in words)
        if rng.random() < 0.3:
            text += "In The Beginning was the word. in the beginning was"
        made.append((text, rng.choice(["en", "en", "de", None])))
    return made


WORDS = ["the", "of", "The", "en", "de", "und", "a", "é", "Straße", "x|y", "漢字", "in", "was", "word", "b", "c", "d"]


@pytest.mark.parametrize("least", [3, 12])
def test_equals_plain_python(spark, least):
    rows = texts(random.Random(least), 150, WORDS)
    wanted = by_hand(rows, least, 40)
    assert len(wanted) > 30 and found(spark, rows, least, 40) == wanted


def test_segments_flushes_and_small_rows(spark, monkeypatch):
    """Every prefix that occurs more than now and then is hot, rows and flushes are small."""
    monkeypatch.setattr(collocations, "HOT_SHARE", 8)
    rows = texts(random.Random(5), 120, WORDS)
    assert found(spark, rows, 4, 1000) == by_hand(rows, 4, 1000)


def test_overlaps_ties_and_copies(spark):
    rows = [("a a a a a a", "en")] * 4 + [("b c, b c; b c. x y x y", "en")] * 3 + [("B c", None)] * 9
    assert found(spark, rows, 3, 100) == by_hand(rows, 3, 100)


def test_rows_of_sequences_end_at_breaks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(collocations, "ROW_WORDS", 5)
    keys = np.arange(1, 41, dtype=np.uint64)
    begins = np.zeros(40, bool)
    begins[[0, 3, 4, 20, 30]] = True
    every = np.full(1 << 13, 255, np.uint8)
    rows = collocations._sequence_rows(keys, begins, every)
    assert all(r[-1] == 0 for r in rows) and len(rows) > 2
    joined = np.concatenate(rows)
    assert joined[joined > 0].tolist() == keys.tolist()
    pieces = [p.split() for p in " ".join(map(str, joined)).split(" 0")]
    assert [len(p) for p in pieces] == [3, 1, 16, 10, 10, 0]


class Value:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


def test_stripes_of_a_task(monkeypatch):
    """Few rows and little memory for many prefixes; all occurrences are in what merges them."""
    monkeypatch.setattr(collocations, "ENTRIES", 20_000)
    rng = np.random.default_rng(5)
    common = rng.integers(1, (1 << 64) - 1, 40, np.uint64)
    batches = []
    for _ in range(40):
        words = rng.integers(1, (1 << 64) - 1, 65_536, np.uint64)
        at = rng.random(len(words)) < 0.2
        words[at] = rng.choice(common, at.sum())
        words[rng.random(len(words)) < 0.1] = 0
        words[-1] = 0
        batches.append(words)
    batches.append(np.tile(np.array([7, 8, 0], np.uint64), 10_000))
    bits, hot = 12, np.sort(common[:20])
    every = Value(np.full(1 << 13, 255, np.uint8))

    def counted(batches):
        stream = (pa.RecordBatch.from_arrays([collocations._as_bytes(w, np.array([0, len(w) // 3, len(w)]))], names=["keys"]) for w in batches)
        return collocations._count_stripes(2, every, Value(hot), bits)(stream)

    tracemalloc.start()
    rows = sum(len(b) for b in counted(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows < 10 << bits and peak < 60e6  # before: a row for each prefix, 1,889,134; 91 MB

    # Spark deals rows by bucket and sorts them.
    monkeypatch.setattr(collocations, "OCCURRENCES", 20_000)
    monkeypatch.setattr(collocations, "HELD_ENTRIES", 60_000)
    batches = batches[-6:]
    table = pa.Table.from_batches(counted(batches)).sort_by("bucket").combine_chunks()
    merged = pa.Table.from_batches(collocations._merge_stripes(2, 2)(iter(table.to_batches(max_chunksize=100))))
    whole = np.concatenate(batches)
    first = whole[:-1] != 0
    wanted = Counter(whole[:-1][first].tolist())
    totals, parts = Counter(), Counter()
    for a, total in zip(merged["a"].to_numpy().view(np.uint64).tolist(), merged["total"].to_pylist(), strict=True):
        totals[a] += total
        parts[a] += 1
    assert totals == wanted
    assert max(parts[a] for a in hot.tolist()) > 50 and all(n == 1 for a, n in parts.items() if a not in hot)
    twice = Counter(zip(whole[:-1][first].tolist(), whole[1:][first].tolist(), strict=True))
    found = Counter()
    for a, words, counts in zip(merged["a"].to_numpy().view(np.uint64).tolist(), merged["words"].to_pylist(), merged["counts"].to_pylist(), strict=True):
        found.update({(a, w % (1 << 64)): n for w, n in zip(words, counts, strict=True)})
    assert found == Counter({p: n for p, n in twice.items() if n >= 2 and p[1]})


def test_number_of_buckets():
    assert [collocations._bucket_bits(n) for n in (0, 10**8, 10**9, 10**12)] == [12, 12, 13, 16]


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**12, 10**13, 10**12, 10**12)], "a long, n long, l long, r long")
    assert big.select(collocations._score()).first()[0] == 1000 * 10**12 * 10**13 // 10**24


def test_tricky_rows(spark):
    docs = tricky.documents(spark)
    rows = [(r[1], r[2]) for r in tricky.TEXTS]
    out = sorted(tuple(r) for r in collocations.collocations(docs, 2, 50).collect())
    assert out == by_hand(rows, 2, 50)
    for empty in (docs.limit(0), docs.where("text = ''")):
        assert collocations.collocations(empty, 1).collect() == []
