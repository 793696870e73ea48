import itertools
import math
import random

import pytest
import tricky

from vacancylens.llm import decontam

RND = random.Random(8)
WORDS = [f"w{k}" for k in range(3000)]


def prose(n):
    return [RND.choice(WORDS) for _ in range(n)]


def run(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(tricky.texts(spark, *docs), benchmark).collect()}


def agree(item, doc):
    """All distances, all windows."""
    width = min(13, len(item))
    for shift in range(-len(item), len(doc)):
        pairs = [(item[k], doc[k + shift]) for k in range(len(item)) if 0 <= k + shift < len(doc)]
        same = [a == b for a, b in pairs]
        if any(100 * sum(same[k : k + width]) >= 80 * width for k in range(len(same) - width + 1)):
            return True
    return False


def test_against_all_distances(spark):
    items = [prose(n) for n in (8, 12, 13, 20, 45, 60)]
    docs = []
    for _ in range(120):
        item = RND.choice(items)
        part = list(item[RND.randrange(0, 6) :]) if RND.random() < 0.5 else list(item)
        for _ in range(RND.randrange(0, 5)):
            part[RND.randrange(len(part))] = "changed"
        docs.append(prose(RND.randrange(0, 60)) + part + prose(RND.randrange(0, 60)))
    got = run(spark, [(k, " ".join(d)) for k, d in enumerate(docs)], [(k, " ".join(i)) for k, i in enumerate(items)])
    expected = {(k, n) for k, d in enumerate(docs) for n, i in enumerate(items) if agree(i, d)}
    assert set(got) <= expected
    # Seeds may miss a passage with a replaced word in every window; whole ones never.
    assert len(expected - set(got)) <= 0.03 * len(expected)
    whole = {(k, n) for k, d in enumerate(docs) for n, i in enumerate(items) if " ".join(i) in " ".join(d)}
    assert whole <= set(got)


def test_marks_case_and_lines_do_not_matter(spark):
    item = prose(20)
    doc = "Before. " + "***\n".join(w.upper() for w in item) + "### after"
    (row,) = run(spark, [(1, doc)], [(5, ", ".join(item))]).values()
    assert (row.start, row.n_words, row.n_same, row.item_words) == (1, 20, 20, 20)


def test_clean_documents_and_short_items(spark):
    docs = [(k, " ".join(prose(300))) for k in range(50)] + [(99, "he said to be or not to be, and left")]
    assert run(spark, docs, [(1, " ".join(prose(40))), (2, "to be or not to be"), (3, None), (4, "")]) == {}


def test_short_items_are_found_as_lines_and_whole_texts(spark):
    short, one = "to be or not to be", "Yes!"
    docs = [(1, "To be, or NOT\nto be?"), (2, "before\n\n - to be or not to be -\nafter"), (3, "to be or not to be it"), (4, "x to be or not to be"),
            (5, "yes"), (6, "no\nyes, yes"), (7, "to be or\nnot"), (8, " ".join(prose(30)) + "\nYES\n" + " ".join(prose(30))), (9, "")]
    got = run(spark, docs, [(1, short), (2, one), (3, "to be or not"), (4, "...")])
    assert set(got) == {(1, 1), (2, 1), (5, 2), (8, 2), (7, 3)} | {(1, 3)}
    assert (got[2, 1].start, got[2, 1].n_words, got[2, 1].n_same) == (1, 6, 6) and got[8, 2].start == 30


def test_repeated_words_and_hot_passages(spark):
    same = " ".join(["again"] * 400)
    docs = [(k, same) for k in range(30)]
    got = run(spark, docs, [(1, " ".join(["again"] * 30))])
    assert len(got) == 30 and {r.n_same for r in got.values()} == {30}


def test_odd_rows(spark):
    docs = tricky.documents(spark)
    benchmark = spark.createDataFrame([(1, tricky.LONG[:400]), (1, tricky.LONG[:400]), (None, "x")], "item_id long, text string")
    got = decontam.contaminated(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(6, 1)]
    left = decontam.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(tricky.TEXTS) - 1
    assert decontam.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("mask", range(len(decontam.MASKS)))
def test_masks_ignore_their_gaps(mask):
    import numpy as np

    hashes = np.arange(100, 100 + len(decontam.MASKS[mask]), dtype=np.uint64)
    for k, c in enumerate(decontam.MASKS[mask]):
        other = hashes.copy()
        other[k] = 7
        assert (decontam.seeds(hashes, mask) == decontam.seeds(other, mask)).all() == (c == "0")


def test_masks_leave_out_all_that_may_differ():
    for n in range(8, 30):
        width = min(n, decontam.WINDOW)
        places = [{s + k for k, c in enumerate(m) if c == "1"} for m in decontam.MASKS for s in range(width - len(m) + 1)]
        replaced = width - math.ceil(decontam.SHARE * width / 100)
        assert all(any(p.isdisjoint(e) for p in places) for e in itertools.combinations(range(width), replaced)), n


def test_every_replacement_in_short_items_is_found(spark):
    items = {n: prose(n) for n in range(8, 15)}
    docs, expected = [], set()
    for n, item in items.items():
        width = min(n, decontam.WINDOW)
        for places in itertools.combinations(range(width), width - math.ceil(decontam.SHARE * width / 100)):
            changed = [f"new{k}" if k in places else w for k, w in enumerate(item[:width])]
            expected.add((len(docs), n))
            docs.append(["before"] * 3 + changed + ["after"] * 3)
    got = run(spark, [(k, " ".join(d)) for k, d in enumerate(docs)], [(n, " ".join(i)) for n, i in items.items()])
    assert all(agree(items[n], docs[k]) for k, n in expected) and set(got) == expected


def test_equal_to_all_distances(spark):
    items = [prose(n) for n in range(8, 21)]
    docs = []
    for _ in range(150):
        part = list(RND.choice(items))[RND.randrange(0, 3) :]
        for _ in range(RND.randrange(0, 5)):
            part[RND.randrange(len(part))] = "changed"
        docs.append(prose(RND.randrange(0, 40)) + part + prose(RND.randrange(0, 40)))
    got = run(spark, [(k, " ".join(d)) for k, d in enumerate(docs)], [(k, " ".join(i)) for k, i in enumerate(items)])
    assert set(got) == {(k, n) for k, d in enumerate(docs) for n, i in enumerate(items) if agree(i, d)}


def test_scripts_without_spaces(spark):
    items = [(1, "今日は朝から雨が降っていたので、家で本を読みました。"), (2, "我们在图书馆里看了一整天的书，然后一起回家"), (3, "วันนี้ฝนตกตั้งแต่เช้าฉันจึงอ่านหนังสือ"), (4, "𠀀𠀁𠀂𠀃𠀄𠀅𠀆𠀇𠀈")]
    docs = [(k, f"前文，{t}後文") for k, t in items] + [(5, "他说：“我们在图书馆里看了—一整天的书。然后 一起回家”！"), (6, "x" + items[1][1][:9] + "yé"), (7, "完全不同的文字在这里写着没有任何关系的内容")]
    got = run(spark, docs, items)
    assert set(got) == {(k, k) for k in range(1, 5)} | {(5, 2)}
    assert got[5, 2].n_same == got[5, 2].n_words == got[5, 2].item_words == 20


def test_documents_are_the_same_with_one_item_a_seed(spark):
    stem = prose(9)
    # Items share half of their passage; a document may hold the half of one and the other half of another.
    items = [stem + prose(12) for _ in range(6)] + [prose(6) + stem for _ in range(3)] + [prose(30)]
    docs = [prose(20) + stem + prose(20) for _ in range(5)] + [prose(5) + i[: 9 + n] + prose(9) for n, i in enumerate(items)]
    docs += [prose(3) + i[4:17] + prose(3) for i in items] + [items[0][:9] + items[1][9:]]
    given = tricky.texts(spark, *((k, " ".join(d)) for k, d in enumerate(docs)))
    benchmark = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    wanted = {k for k, d in enumerate(docs) if any(agree(i, d) for i in items)}
    assert {r.doc_id for r in decontam.contaminated_ids(given, benchmark).collect()} == wanted and 0 < len(wanted) < len(docs)
    assert {r.doc_id for r in decontam.drop_contaminated(given, benchmark).collect()} == set(range(len(docs))) - wanted


def test_a_passage_of_many_items_makes_one_pair_for_a_document(spark, monkeypatch):
    stem = " ".join(prose(20))
    docs = tricky.texts(spark, *((k, f"{stem} own d{k}") for k in range(150)))
    benchmark = spark.createDataFrame([(n, f"{stem} end {n}") for n in range(150)], "item_id long, text string")
    pairs, confirmed = [], decontam._confirmed
    monkeypatch.setattr(decontam, "_confirmed", lambda narrow, items, met: pairs.append(met.select("doc_id", "item_id").distinct().count()) or confirmed(narrow, items, met))
    assert decontam.contaminated_ids(docs, benchmark).count() == 150
    assert pairs == [150, 0]
