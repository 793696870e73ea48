import zlib

import numpy as np
import public_tokenizers
import pytest
import tricky
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from vacancylens.llm import wavelet
from vacancylens.llm.tokens import TokenizerFile
from vacancylens.session import new_folder

FILE = TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"), "byte")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500), st.data())
def test_answers_equal_those_of_the_list(ids, data):
    matrix = wavelet.WaveletMatrix.of(np.array(ids, np.uint32), 6)
    assert matrix.decode().tolist() == ids
    token = data.draw(st.integers(0, 45))
    places = [k for k, i in enumerate(ids) if i == token]
    assert matrix.count(token) == len(places) and matrix.occurrences(token).tolist() == places
    if ids:
        at = data.draw(st.integers(0, len(ids) - 1))
        assert matrix.access(at) == ids[at] and matrix.rank(token, at) == ids[:at].count(token)
    if places:
        k = data.draw(st.integers(0, len(places) - 1))
        assert matrix.select(token, k) == places[k]
    with pytest.raises(IndexError):
        matrix.select(token, len(places))


def test_large_ids_and_bytes_round_trip():
    ids = np.random.default_rng(1).integers(0, 1 << 20, 5000).astype(np.uint32)
    blob = wavelet.to_bytes(ids, np.arange(3), np.array([1000, 0, 4000]), 20)
    matrix, docs, lengths = wavelet.from_bytes(blob)
    assert (matrix.decode() == ids).all() and docs.tolist() == [0, 1, 2] and lengths.tolist() == [1000, 0, 4000]
    assert matrix.access(4999) == ids[4999]


def test_query_equals_the_tokenizer(spark):
    sf = "/root/testdata/sf0.01"
    rows = sorted(entry.queries()["op7_wavelet_shards"](spark, sf).collect())
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    tokenizer = Tokenizer.from_file(FILE.path)
    tokenizer.encode_special_tokens = True
    start = 0
    for row, doc in zip(rows, docs, strict=True):
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_rows_lookup_and_order(spark, monkeypatch):
    docs = tricky.documents(spark).filter("doc_id is not null").repartition(5)
    path = new_folder(spark, "shards")
    wavelet.write_shards(docs, path, FILE)
    shards = wavelet.read_shards(spark, path)
    rows = sorted(wavelet.documents(shards).collect())
    assert [r.doc_id for r in rows] == sorted(t[0] for t in tricky.TEXTS if t[0] is not None)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    ids = dict(wavelet.token_ids(shards).filter("doc_id <> 7").collect())
    token = ids[8][0]
    expected = {(r.doc_id, r.start + k) for r in rows if r.doc_id in ids for k, i in enumerate(ids[r.doc_id]) if i == token}
    assert {tuple(r) for r in wavelet.occurrences(shards, token).filter("doc_id <> 7").collect()} == expected
    assert wavelet.count_token(shards, 0).first().n == len(rows)


def test_empty_table(spark):
    path = new_folder(spark, "shards")
    wavelet.write_shards(tricky.documents(spark, []), path, FILE)
    assert wavelet.documents(wavelet.read_shards(spark, path)).count() == 0


def test_a_row_without_an_id_fails(spark):
    with pytest.raises(Exception, match="has no place"):
        wavelet.write_shards(tricky.documents(spark), new_folder(spark, "shards"), FILE)


def test_ids_of_any_width_round_trip():
    for ids in ([70000, 5, 65543, 0], [2**32 - 1, 7], [0, 0], [1], []):
        given = np.array(ids, np.uint32)
        blob = wavelet.to_bytes(given, np.arange(1), np.array([len(ids)]))
        matrix = wavelet.from_bytes(blob)[0]
        assert matrix.decode().tolist() == ids and [matrix.access(k) for k in range(len(ids))] == ids
        assert all(matrix.count(i) == ids.count(i) for i in ids) and matrix.count(2**33) == 0
    with pytest.raises(ValueError, match="more than 16 bits"):
        wavelet.to_bytes(np.array([70000], np.uint32), np.arange(1), np.array([1]), 16)
