import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tricky
from tokenizers import Tokenizer

import __spark_entry__ as entry
from vacancylens.llm import arrays, packing, tokens

WORD = tokens.TokenizerFile(public_tokenizers.path("word_bpe_49k.json"), "word")
BYTE = tokens.TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"), "byte")
PIECES = ["a", "B", "foo", " ", "  ", "\n", "\t", "'s", "'S", "'", "’", "é", "É", "ñ", "́", "漢", " ", "　"]
PIECES += [" ", "1", "0", "23", ",", ".", "!?", "...", "##", "\x1c", "\x00", "\u0085", "😀", "ß", "İ", "Σ", "\r\n"]
PIECES += ["<|endoftext|>", "ﬁ", "Å", "_", "-"]


def encode(file, rows):
    tokenizer = Tokenizer.from_file(file.path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([r or "" for r in rows], add_special_tokens=False)]


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_units_give_the_ids_of_whole_texts(file, monkeypatch):
    monkeypatch.setattr(tokens, "STORED_UNITS", 300)
    rnd = random.Random(2)
    rows = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    rows += ["", "x" * 9000 + " y", *(t for _, t, *_ in tricky.TEXTS if t and len(t) < 1000)]
    encoder, got = tokens.Encoder(file), []
    for chunk in arrays.texts(pa.array(rows), 5000):
        ids, first = encoder.encode(chunk)
        got += [ids[first[k] : first[k + 1]].tolist() for k in range(len(chunk))]
    assert got == encode(file, rows)


def check_places(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        at = 0
        for offset, length in places:
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query_holds_the_contract_and_packs_tightly(spark):
    sf = "/root/testdata/sf0.01"
    rows = entry.queries()["op4_best_fit_packing"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    expected = set()
    for d, ids in zip(docs, encode(WORD, [d.text for d in docs])):
        ids = [*ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[lo : lo + 4096], "<u4")
            expected.add((d.doc_id, k, lo, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    used = check_places(rows, 4096)
    assert used <= math.ceil(sum(r.length for r in rows) / 4096) + 1


def test_odd_rows(spark):
    rows = packing.pack_documents(tricky.documents(spark), WORD, end_id=1, capacity=512).collect()
    check_places(rows, 512)
    assert {r.doc_id for r in rows} == {r[0] for r in tricky.TEXTS}
    assert [r.length for r in rows if r.doc_id in (2, 3, 4)] == [1, 1, 1]
    assert sum(r.doc_id == 7 for r in rows) == 2
    assert packing.pack_documents(tricky.documents(spark, []), WORD).count() == 0


def test_local_search_empties_bins():
    # Best fit needs four bins here; moving and exchanging fits all into three.
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    assert len(packing.pack_block(lengths, 10)) == 3
    start = [[0], [1, 3], [2, 4], [5, 6]]
    better = packing.improve([list(b) for b in start], lengths, 10)
    assert len(better) == 3 and sorted(k for b in better for k in b) == list(range(7))


@pytest.mark.parametrize("low, high, most", [(1200, 1600, 360), (1000, 1400, 316), (600, 1000, 192)])
@pytest.mark.parametrize("seed", [1, 2])
def test_the_search_saves_bins_of_best_fit(seed, low, high, most):
    lengths = np.random.default_rng(seed).integers(low, high, 970)
    packed = packing.pack_block(lengths, 4096)
    assert sorted(k for b in packed for k in b) == list(range(970)) and max(lengths[b].sum() for b in packed) <= 4096
    assert len(packed) <= most and len(packed) < len(packing.best_fit(lengths, 4096))


def every_step(state, target):
    """Gains of all steps there are for a bin, by trying them."""
    gains = set()
    sizes, groups = state.lengths, lambda b: [(k,) for k in state.members[b]] + [(i, j) for n, i in enumerate(state.members[b]) for j in state.members[b][n + 1 :]]
    for donor in state.underfull():
        for give in groups(donor) if donor != target else []:
            for take in [(), *groups(target)]:
                gain = sum(sizes[k] for k in give) - sum(sizes[k] for k in take)
                allowed = len(give) + len(take) < 4 and 0 < gain <= state.capacity - state.fill[target]
                if allowed and state.fill[target] + gain > state.fill[donor]:
                    gains.add(int(gain))
    return gains


@pytest.mark.parametrize("seed, compared", [(0, 1 << 20), (1, 1), (2, 5)])
def test_no_step_is_overlooked(seed, compared, monkeypatch):
    monkeypatch.setattr(packing, "COMPARED", compared)
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 40, 60)
    bins = [[] for _ in range(20)]
    for k in range(60):
        fitting = [b for b in bins if sum(lengths[b]) + lengths[k] <= 100]
        fitting[rnd.integers(len(fitting))].append(k)
    state = packing._Bins([b for b in bins if b], lengths, 100)
    steps = 0
    while True:
        squares, found = int((state.fill**2).sum()), None
        partners = state.sorted_groups()
        for target in state.underfull():
            step, gains = state.best_step(target, partners), every_step(state, target)
            assert (step is None) == (not gains) and (step is None or step[2] == max(gains))
            found = found or (step and (target, step))
        if found is None:
            break
        state.apply(found[0], *found[1])
        assert int((state.fill**2).sum()) > squares
        steps += 1
    assert steps > 5


@pytest.mark.parametrize("seed", range(5))
def test_blocks_keep_all_pieces(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 101, 400)
    packed = packing.pack_block(lengths, 100)
    assert sorted(k for b in packed for k in b) == list(range(400))
    assert max(lengths[b].sum() for b in packed) <= 100
    assert len(packed) <= len(packing.best_fit(lengths, 100))


def test_levels_join_the_open_bins_of_blocks(spark):
    rnd = random.Random(4)
    rows = [(k, rnd.randint(1, 300)) for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, length long").repartition(7)
    packed = packing.pack(frame, 1000).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == rows
    assert check_places(packed, 1000) <= 1.02 * math.ceil(sum(n for _, n in rows) / 1000) + 1


def test_levels_go_on_while_they_save_sequences(spark, monkeypatch):
    lengths = [int(n) for n in np.random.default_rng(3).integers(300, 401, 900)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").repartition(9)
    levels, pack_level = [], packing._pack_level
    monkeypatch.setattr(packing, "_pack_level", lambda rows, level, capacity: levels.append(level) or pack_level(rows, level, capacity))
    packed = packing.pack(frame, 1024).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == list(enumerate(lengths)) and levels[:2] == [0, 1]
    assert check_places(packed, 1024) < len(packing.best_fit(np.array(lengths), 1024))
