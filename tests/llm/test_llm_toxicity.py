import numpy as np
import pyarrow as pa
import tricky

import __spark_entry__ as entry
from vacancylens.llm import arrays, language, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_rows_and_contract(spark):
    rows = entry.queries()["op10_toxicity"](spark, SF).collect()
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(p and t for p, t in held)
    # Some labels of this table have no cause in the text.
    assert hits / sum(t for _, t in held) > 0.85 and hits / sum(p for p, _ in held) > 0.8


def toy(n=400):
    rnd = np.random.default_rng(0)
    rows = []
    for k in range(n):
        text = " ".join(f"plain{i}" for i in rnd.integers(0, 300, 30))
        rows.append((k, text + (f" nasty{k % 7} plain1 nasty{k % 5}" if k % 5 == 0 else "")))
    return rows


def test_learns_words_forms_and_empty_texts(spark):
    docs = tricky.texts(spark, *toy())
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in toy()], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0)))
    new = tricky.texts(spark, (1, "plain1 plain2 NASTY3, plain4 nasty"), (2, "plain1 plain2 plain3 plain4"), (3, None), (4, ""), (5, "nasties plain9 nastier nastiest"))
    got = {r.doc_id: r for r in toxicity.score(new, model).collect()}
    assert [got[k].predicted for k in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert got[5].score > got[2].score  # forms of a learned stem
    assert got[3].score == got[4].score
    odd = toxicity.score(tricky.documents(spark), model)
    assert odd.count() == len(tricky.TEXTS) and toxicity.score(tricky.documents(spark, []), model).count() == 0


def test_long_texts_are_seen_whole(spark):
    docs = tricky.texts(spark, *toy())
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in toy()], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0)))
    long = " ".join(["plain1"] * 3 * toxicity.SPAN) + " nasty1 plain nasty2"
    (chunk,) = arrays.texts(pa.array([long]))
    buckets, _ = toxicity.word_buckets(chunk)
    assert model.logit(buckets) > model.logit(buckets[:-3])
    assert model.scores(chunk)[0] >= toxicity.CUT


def test_without_labels_nothing_is_toxic(spark):
    none = language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(tricky.texts(spark, (1, "a b")), labels, none)
    assert {r.predicted for r in toxicity.score(tricky.documents(spark), model).collect()} == {0}


def test_thresholds_by_language_meet_the_cut():
    none = language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0))
    model = toxicity.ToxicityModel([], [], np.zeros(0), 0.0, none, {None: (1.0, 0.0, 0.5), 1: (1.0, 0.0, 0.8)})
    z = np.log(np.array([0.5, 0.79, 0.8, 0.9]) / (1 - np.array([0.5, 0.79, 0.8, 0.9])))
    assert (model.calibrated(z, np.zeros(4, int)) >= toxicity.CUT).tolist() == [True] * 4
    strict = model.calibrated(z + 1e-12, np.ones(4, int))
    assert (strict >= toxicity.CUT).tolist() == [False, False, True, True] and (np.diff(strict) > 0).all()


def plain_logit(model, buckets):
    """Every filter at every place of a text, one by one."""
    z = model.out_bias
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            answers = [
                sum(float(model.tables[k][place][b, f]) for place in range(width) for b in buckets[at + place].tolist()) + float(model.biases[k][f])
                for at in range(len(buckets) - width + 1)
            ]
            z += max([0.0, *answers]) * float(model.out[k * toxicity.FILTERS + f])
    return z


def test_logits_equal_a_plain_convolution(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SPAN", 7)
    docs = tricky.texts(spark, *toy(200))
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(200)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0)))
    texts = [t for _, t in toy(30)] + ["", "nasty1", "plain1 nasty2", "a b c d"]
    for chunk in arrays.texts(pa.array(texts)):
        buckets, first = toxicity.word_buckets(chunk)
        for k in range(len(chunk)):
            own = buckets[first[k] : first[k + 1]]
            assert abs(model.logit(own) - plain_logit(model, own)) < 1e-4


def test_longer_texts_are_scored_and_not_learned_from(spark, monkeypatch):
    long = "nasty1 " * 400
    docs = tricky.texts(spark, *toy(100), (1000, long))
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(100)] + [(1000, 0)], "doc_id long, toxic int")
    none = language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0))
    with_it = toxicity.train(docs, labels, none)
    monkeypatch.setattr(toxicity, "LONGEST", 1000)
    without = toxicity.train(docs, labels, none)
    again = toxicity.train(docs.where("doc_id < 1000"), labels, none)
    assert (without.out == again.out).all() and (with_it.out != again.out).any()
    assert toxicity.score(docs, without).where("doc_id = 1000").count() == 1


def no_languages():
    return language.LanguageModel([], np.zeros((0, language.BUCKETS + 1)), np.zeros(0))


def test_every_labelled_row_is_learned_from(spark):
    def name(k):
        return "".join(chr(97 + k // 26**j % 26) for j in range(4))

    # Each word is in four of the texts learned from: too few for it in any smaller part of them.
    ids = [k for k in range(16_000) if k % 4 != 1]
    rows = [(d, f"{name(7 * (at // 8))} w", int(at % 8 < 4)) for at, d in enumerate(ids)]
    rows = [(d, ("q" if toxic else "z") + text, toxic) for d, text, toxic in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), no_languages())
    (chunk,) = arrays.texts(pa.array(sorted({text.split()[0] for _, text, _ in rows})))
    buckets, _ = toxicity.word_buckets(chunk)
    assert len(buckets) == 3000
    assert (model.tables[0][0][buckets[:, 0]] != 0).any(axis=1).all()


def test_a_threshold_is_the_best_of_all_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(code, float(p), int(rnd.random() < p * (code + 1) / 3)) for code in (-1, 0, 2) for p in rnd.integers(0, 900, 3000) / 1000]
    rows += [(5, 0.25, 1)] * 10 + [(5, 0.25, 0)] * 3 + [(6, 0.5, 0), (6, 0.75, 1)]
    points = spark.createDataFrame(rows, "code int, p double, toxic int").repartition(9)
    got = toxicity._best_threshold(points)
    assert sorted(got) == [-1, 0, 2, 5, 6] and got[5] == 0.125 and got[6] == 0.625
    for code in (-1, 0, 2):
        own = [(p, y) for c, p, y in rows if c == code]
        values = sorted({p for p, _ in own}, reverse=True)
        toxic = sum(y for _, y in own)

        def f1(cut, own=own, toxic=toxic):
            return 2 * sum(y for p, y in own if p >= cut) / (sum(p >= cut for p, _ in own) + toxic)

        best = max(values, key=f1)
        below = max((p for p in values if p < best), default=0.0)
        assert got[code] == (best + below) / 2


def test_calibration_is_the_logistic_regression_of_all_rows(spark):
    rnd = np.random.default_rng(5)
    z = rnd.normal(1, 3, 4000)
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(0.7 * z - 1)))).astype(int)
    points = spark.createDataFrame(list(zip([0] * 4000, z.tolist(), y.tolist(), strict=True)), "code int, z double, toxic int").repartition(7)
    slope, shift = toxicity._logistic(points, {0: (z.mean(), z.std())})[0]
    p = 1 / (1 + np.exp(-(slope * z + shift)))
    assert abs((p - y).sum()) < 1e-3  # the shift has no prior but a tiny one
    assert abs(((p - y) * (z - z.mean()) / z.std()).sum() + slope * z.std() - 1) < 1e-3


def test_shards_learn_whatever_the_layout(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 100)
    rows = toy(1200)
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in rows], "doc_id long, toxic int")
    one = toxicity.train(tricky.texts(spark, *rows), labels, no_languages())
    monkeypatch.setattr("vacancylens.llm.frames.BROADCAST_ROWS", 10)  # labels are shuffled, as many are
    other = toxicity.train(tricky.texts(spark, *rows[::-1]).repartition(5), labels.repartition(3), no_languages())
    assert (one.out == other.out).all() and all((a == b).all() for a, b in zip(one.tables[2], other.tables[2], strict=True))
    new = tricky.texts(spark, (1, "plain1 plain2 NASTY3, plain4 nasty"), (2, "plain1 plain2 plain3 plain4"))
    assert {r.doc_id: r.predicted for r in toxicity.score(new, one).collect()} == {1: 1, 2: 0}


def test_a_long_text_is_learned_in_spans(monkeypatch):
    rnd = np.random.default_rng(1)
    counts = rnd.integers(3, 900, (2, toxicity.BUCKETS + 1))
    counts[:, toxicity.BUCKETS] = 1000
    buckets = rnd.integers(0, toxicity.BUCKETS, (50, 2)).astype(np.uint16)
    whole = toxicity._Network(1, counts)
    parts = whole.copy()
    whole.step(buckets, 0, np.float32(0.1))
    monkeypatch.setattr(toxicity, "SPAN", 7)
    parts.step(buckets, 0, np.float32(0.1))
    assert np.allclose(whole.embedding, parts.embedding) and np.allclose(whole.dense(), parts.dense()) and whole.moved.any()
