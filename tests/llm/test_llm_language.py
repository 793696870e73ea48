import math

import numpy as np
import pyarrow as pa
import pytest
import tricky

import __spark_entry__ as entry
from vacancylens.llm import arrays, language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    rows = entry.queries()["op1_language_id"](spark, SF).collect()
    truth = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = tricky.documents(spark)
    model = language.train(docs.filter("lang is not null"))
    got = language.predict(docs, model).collect()
    assert len(got) == len(tricky.TEXTS)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 4, 5}
    assert all(r.rejected and r.score == 0 for r in got if r.lang_pred == "und")
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 6, 7, None}
    assert kept.filter("`a.b` = 1 and rep = 0.5 and _rest = 'r'").count() == kept.count()


def test_nothing_to_learn_or_label(spark):
    empty = tricky.documents(spark, [])
    model = language.train(empty)
    assert language.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language.predict(tricky.documents(spark), model).collect()} == {"und"}
    assert language.keep_known(tricky.documents(spark), model).count() == 0


def test_a_text_of_no_known_script_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    assert language.keep_known(docs, model).count() >= 0.995 * docs.count()
    # The calibrated score does its part by itself.
    assert 1 / len(model.languages) < model.least < 1
    model.most_unseen[:] = float("inf")
    assert language.keep_known(docs, model).count() >= 0.995 * docs.count()
    got = language.predict(tricky.texts(spark, *enumerate(UNLEARNED)), model).collect()
    assert sum(r.rejected for r in got) >= len(UNLEARNED) - 1


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        language.train(spark.read.parquet(f"{SF}/documents.parquet"))


def by_hand(text, model):
    """A text's logits from its subwords, one by one."""
    symbols = [b if bytes([b]).isalpha() or b >= 128 else 0x20 for b in text.lower().encode()]
    counts = {}
    for size in language.SIZES:
        for at in range(len(symbols) - size + 1):
            run = symbols[at : at + size]
            if 0x20 in run[1:-1] or all(s == 0x20 for s in run):
                continue
            bucket = 0
            for k, symbol in enumerate(run):
                bucket ^= int(language._TABLES[k][symbol])
            counts[bucket] = counts.get(bucket, 0) + 1
    total = sum(counts.values())
    return [sum(float(row[b]) * n for b, n in counts.items()) / total + float(bias) for row, bias in zip(model.scores, model.bias)]


def test_scores_equal_a_sum_over_subwords(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    texts = ["The quick brown fox", "Der Fuchs, 12 x", "aé b--c", "que el de la", "OF THE and"]
    got = {r.doc_id: r for r in language.predict(tricky.texts(spark, *enumerate(texts)), model).collect()}
    for k, text in enumerate(texts):
        z = [x / model.temperature for x in by_hand(text, model)]
        p = [math.exp(x - max(z)) for x in z]
        assert got[k].lang_pred == model.languages[z.index(max(z))]
        assert got[k].score == pytest.approx(max(p) / sum(p), abs=1e-4)


UNLEARNED = [
    "La città era silenziosa quella mattina, e nessuno sapeva perché le finestre fossero chiuse. Gli uomini camminavano lentamente verso la piazza.",
    "Kaupunki oli hiljainen sinä aamuna, eikä kukaan tiennyt miksi ikkunat olivat kiinni. Miehet kävelivät hitaasti kohti toria ja puhuivat vähän.",
    "O sabah şehir sessizdi ve kimse pencerelerin neden kapalı olduğunu bilmiyordu. Adamlar yavaşça meydana doğru yürüyor ve az konuşuyorlardı.",
    "Miasto było ciche tego ranka i nikt nie wiedział, dlaczego okna były zamknięte. Mężczyźni powoli szli w stronę placu.",
    "xqzk vrtwp jjkq zzxv qwpk bvnm xcvb wqzx kjhg pqow zmxn qpwk lkjq vbzx wqpz xkcd jqkz mnbv zxqw",
    "Город был тих в то утро, и никто не знал, почему окна были закрыты.",
    "那天早上城市很安静，没有人知道为什么窗户都关着。",
]


def test_unlearned_languages_go_and_learned_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(docs.filter("doc_id % 5 <> 0"))
    got = language.predict(tricky.texts(spark, *enumerate(UNLEARNED)), model).collect()
    assert [r.doc_id for r in got if not r.rejected] == []
    assert language.keep_known(tricky.texts(spark, *enumerate(UNLEARNED)), model).count() == 0
    held = docs.filter("doc_id % 5 = 0 and lang is not null")
    labels = {r.doc_id: r for r in language.predict(held, model).collect()}
    right = [labels[r.doc_id] for r in held.select("doc_id", "lang").collect() if labels[r.doc_id].lang_pred == r.lang]
    assert sum(r.rejected for r in right) <= 0.003 * len(right)


def test_counted_model_has_the_subwords_of_every_row(spark):
    ids = range(4000)
    rows = [(k, f"bon{k % 97} jour{k}", "fr") if k % 2 else (k, f"guten{k % 89} tag{k}", "de") for k in ids]
    # As rare as a language can be, and a text that only one row has.
    rows += [(5000, "xylofoon " * 5, "nl"), (5001, "qqvvzz", "fr"), (5002, None, "it"), (5003, "kein", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    model = language.counted(docs)
    assert model.languages == ["de", "fr", "nl"]
    n = np.zeros((3, language.BUCKETS))
    for _, text, lang in rows:
        if text is not None and lang is not None:
            (chunk,) = arrays.texts(pa.array([text]))
            for bucket in language.subwords(chunk):
                np.add.at(n[model.languages.index(lang)], bucket[bucket < language.BUCKETS], 1)
    overall = n.sum(axis=0) + 0.5
    n += language.PRIOR * overall / overall.sum()
    assert np.allclose(model.scores[:, :-1], np.log(n / n.sum(axis=1, keepdims=True))) and not model.scores[:, -1].any()
    (chunk,) = arrays.texts(pa.array(["guten tag", "bon jour", "xylofoon", "qqvvzz"]))
    assert [model.languages[k] for k in model.logits(chunk).argmax(axis=1)] == ["de", "fr", "nl", "fr"]
    assert language.counted(docs.limit(0)).languages == []
