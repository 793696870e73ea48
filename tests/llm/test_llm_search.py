import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import tricky

from vacancylens.llm import search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(docs, items, top=50):
    held = [(doc, Counter(terms_of(text))) for doc, text in docs if doc is not None]
    held = [(doc, c) for doc, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def check(spark, docs, items, top=50):
    out = search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), top
    )
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in out.collect()) == by_hand(docs, items, top)


VOCABULARY = [f"w{k}" for k in range(300)] + ["The", "straße", "é", "漢字"]


def texts(rng, n, longest):
    weights = [1 / (k + 1) for k in range(len(VOCABULARY))]
    return [rng.choice([" ", ", ", "-"]).join(rng.choices(VOCABULARY, weights, k=rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("top, block", [(50, 16_384), (5, 40), (1, 7)])
def test_equals_plain_python(spark, monkeypatch, top, block):
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "BATCH_DOCS", 3)
    rng = random.Random(top)
    docs = list(zip(rng.sample(range(10_000), 400), texts(rng, 400, 80), strict=True))
    items = list(enumerate(texts(rng, 20, 400)))  # more than 64 different terms
    check(spark, docs, items, top)


def test_several_sets_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "SET_TERMS", 60)
    rng = random.Random(3)
    check(spark, list(enumerate(texts(rng, 60, 30))), list(enumerate(texts(rng, 12, 30))), 10)


def test_copies_and_ties(spark):
    docs = [(doc, "one two three") for doc in range(200, 0, -1)] + [(300, "one"), (301, "one one"), (302, "two")]
    check(spark, docs, [(1, "ONE two"), (2, "three"), (3, "absent"), (1, "two ..."), (4, None), (None, "one"), (5, "")], 50)


def test_tricky_rows(spark):
    items = [(1, "The quick brown fox"), (2, "word"), (3, "漢字 é́ 123 word5")]
    rows = [(r[0], r[1]) for r in tricky.TEXTS]
    docs, asked = tricky.documents(spark), spark.createDataFrame(items, "item_id long, text string")
    out = sorted(tuple(r) for r in search.search(docs, asked).collect())
    assert out == by_hand(rows, items)
    assert search.search(docs.limit(0), asked).collect() == []
    assert search.search(docs, asked.limit(0)).collect() == []
    assert search.search(docs.where("text is null"), asked).collect() == []


def test_only_documents_that_may_be_among_the_best_are_scored(monkeypatch):
    rng = np.random.default_rng(1)
    n = 4000
    common, rare = np.arange(n), np.sort(rng.choice(n, 60, replace=False))
    rows = np.concatenate([common, rare])
    parts = {
        "docs": np.arange(n) * 3, "sizes": np.full(n, 20), "terms": np.array([0, 1]), "ends": np.array([n, n + 60]), "rows": rows, "counts": np.ones(len(rows), int)
    }
    block = search.Block([parts], np.array([1, 5000]), n, 20 * n)
    scored = []
    whole = search.Block.scores
    monkeypatch.setattr(search.Block, "scores", lambda self, at, docs: scored.extend(docs) or whole(self, at, docs))
    best = search.Best(50)
    search.search_block(block, np.array([0, 1]), best)
    assert set(best.docs // 3) == set(rare[:50].tolist()) and len(scored) < 200
    distinct, group = search.masks(block, np.array([0, 1]), np.arange(n))
    assert len(distinct) == 2 and sorted(np.bincount(group)) == [60, n - 60]
