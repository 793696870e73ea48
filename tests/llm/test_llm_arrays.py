import random
import re

import numpy as np
import pyarrow as pa
import pytest
import tricky

from vacancylens.llm import arrays

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sample(n=300):
    rnd = random.Random(5)
    pieces = ["a", "Bc", " ", "\n", "\t\t", "é", "漢", " ", "\x1c", "...", "0", "\x00"]
    return ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + ["", "y" * 5000]


@pytest.mark.parametrize("block", [64, 1000, 1 << 18])
@pytest.mark.parametrize("limit", [1, 100, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, block, limit):
    monkeypatch.setattr(arrays, "BLOCK", block)
    monkeypatch.setattr(arrays, "_powers", [])
    rows, hashes = sample(), {}
    row = 0
    for chunk in arrays.texts(pa.array(rows), limit):
        found = arrays.words(chunk)
        for k in range(len(chunk)):
            span = slice(found.first[k], found.first[k + 1])
            got = [chunk.data[a:b].tobytes() for a, b in zip(found.starts[span], found.ends[span])]
            assert got == WORD.findall(rows[row].encode())
            for word, h in zip(got, found.hashes[span].tolist()):
                assert hashes.setdefault(word, h) == h
            row += 1
    assert row == len(rows) and len(set(hashes.values())) == len(hashes)


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    chunk = next(arrays.texts(pa.array([tricky.LONG])))
    whole = arrays.words(chunk).hashes
    monkeypatch.setattr(arrays, "BLOCK", 4096)
    monkeypatch.setattr(arrays, "_powers", [])
    assert (arrays.words(chunk).hashes == whole).all()


def test_nulls_are_empty_texts():
    chunk = next(arrays.texts(pa.array([None, "a b", None])))
    assert arrays.words(chunk).counts.tolist() == [0, 2, 0]


def test_shingle_sets():
    chunk = next(arrays.texts(pa.array(["a b c a b c", "A b C", "a b", "b a", "", "a b c d"])))
    sets = arrays.shingle_sets(arrays.words(chunk, arrays.LOWER), 3)
    assert [len(s) for s in sets] == [3, 1, 1, 1, 0, 2]
    assert set(sets[1].tolist()) < set(sets[0].tolist()) and sets[2] != sets[3]
    assert len(np.intersect1d(sets[1], sets[5])) == 1


def test_prefixes():
    found = arrays.words(next(arrays.texts(pa.array(["lowering lower low"]))), prefix=3)
    assert len(set(found.prefixes.tolist())) == 1 and len(set(found.hashes.tolist())) == 3
