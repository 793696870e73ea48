import random
import re

import pytest
import tricky

from vacancylens.llm import dedup
from vacancylens.llm.components import connected_components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_force(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    return sets, smallest(ids, links)


def corpus(seed, bases, copies, words=60):
    """Groups of near copies at all distances, so that most links are indirect."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for _ in range(bases):
        base = [f"w{rnd.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randrange(0, 7)):
                own[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
            rows.append((n, " ".join(own)))
            n += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, percent, bases, copies", [(3, 85, 12, 25), (5, 80, 2, 400)])
def test_components_are_those_of_all_pairs(spark, k, percent, bases, copies):
    rows = corpus(k, bases, copies)
    sets, expected = brute_force(rows, k, percent)
    got = dedup.near_duplicates(tricky.texts(spark, *rows), k, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)
    assert 1 < len(set(expected.values())) < len(rows)


def test_blocks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 16)
    rows = corpus(9, 1, 150)
    got = dedup.near_duplicates(tricky.texts(spark, *rows), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_force(rows, 3, 85)[1]


def test_odd_rows(spark):
    got = dedup.near_duplicates(tricky.documents(spark), 3, 85).collect()
    assert len(got) == len(tricky.TEXTS)
    assert all(r.kept and r.component_id == r.doc_id for r in got if r.doc_id is not None)
    assert {r.doc_id for r in got if r.n_shingles == 0} == {2, 3, 4}
    (lost,) = [r for r in got if r.doc_id is None]
    assert lost.kept and lost.component_id is None
    kept = dedup.keep_first(tricky.documents(spark))
    assert kept.columns == tricky.documents(spark).columns and kept.count() == len(tricky.TEXTS)
    assert dedup.near_duplicates(tricky.documents(spark, [])).count() == 0


def test_one_id_with_two_texts_links_both(spark):
    rows = [(4, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f"), (3, "g h i j k l")]
    got = dedup.near_duplicates(tricky.texts(spark, *rows), 3, 85).collect()
    assert {r.component_id for r in got} == {2}


def test_only_the_first_of_a_group_stays(spark):
    rows = [(k, "the same words in every copy of this text") for k in range(50, 20, -1)] + [(99, "something else")]
    assert sorted(r.doc_id for r in dedup.keep_first(tricky.texts(spark, *rows)).collect()) == [21, 99]


def test_connected_components(spark):
    rnd = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 640)]
    mixed = [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)]
    links = chain + star + mixed + [(7, 7), (1, None)]
    frame = spark.createDataFrame(links, "a long, b long")
    proper = [(a, b) for a, b in links if b is not None and a != b]
    expected = smallest({n for e in proper for n in e}, proper)
    rows = connected_components(frame).collect()
    assert {r.node: r.component for r in rows} == expected and len(rows) == len(expected)
    assert connected_components(frame.limit(0)).count() == 0


def test_signature_limit_leaves_room():
    assert 0 < dedup.least_matches(80) < dedup.least_matches(85) < 0.8 * dedup.HASHES
