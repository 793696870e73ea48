import random
from collections import defaultdict

import tricky
from plantext import planned
from pyspark.sql import functions as F

from vacancylens.llm import linededup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(linededup.SPACES).translate(LOWER)


def by_hand(rows):
    """Per row the lines that stay, as lists of flags."""
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), doc), doc)
    return [
        [doc is None or len(key(line)) < 10 or first[key(line)] == doc for line in (text or "").split("\n")] for doc, text in rows
    ]


def kept(text, flags):
    return "\n".join(line for line, stays in zip((text or "").split("\n"), flags, strict=True) if stays)


def check(spark, rows):
    docs = tricky.texts(spark, *rows).repartition(5)
    bitmaps = linededup.keep_bitmaps(docs)
    found = defaultdict(list)
    for r in linededup.kept_texts(docs, bitmaps).collect():
        found[r.doc_id].append((r.n_lines, r.n_dropped, r.text or ""))
    wanted = defaultdict(list)
    for (doc, text), flags in zip(rows, by_hand(rows), strict=True):
        wanted[doc].append((len(flags), flags.count(False), kept(text, flags)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    return bitmaps


def test_equals_plain_python(spark):
    rng = random.Random(7)
    pool = [f"{'the same line' * (k % 3)} number {k}" for k in range(40)] + ["short", "", " \t", "ÄÖÜ äöü ßßß x", "äÖÜ äöü ßßß x"]
    rows = []
    for doc in rng.sample(range(1000), 120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 12))]
        lines = [rng.choice(["", "  ", "\t\x0b"]) + (line.upper() if rng.random() < 0.2 else line) + rng.choice(["", "\r", " "]) for line in lines]
        rows.append((doc, "\n".join(lines)))
    check(spark, rows)


def test_a_common_line_and_ids_in_any_order(spark):
    common = "All rights reserved, worldwide."
    rows = [(doc, f"{common}\nline of {doc} alone\n {common.upper()}\n\n{common}") for doc in range(400, 0, -1)]
    bitmaps = check(spark, rows)
    runs = {r.doc_id: r.keep for r in bitmaps.where("doc_id in (1, 2)").collect()}
    assert runs == {1: [(0, 5)], 2: [(1, 1), (3, 1)]}


def test_odd_rows(spark):
    # Rows without an id neither drop nor lose lines; rows of one id are one document.
    rows = [(None, "a line of some length\nx"), (3, "a line of some length\nx"), (3, "x\na line of some length"), (3, "x\na line of some length"),
            (9, "a line of some length"), (4, None), (5, ""), (6, "\n\n"), (None, None)]
    check(spark, rows)
    out = {r.doc_id: r.text for r in linededup.drop_repeated_lines(tricky.texts(spark, *rows)).where("doc_id > 3").collect()}
    assert out == {9: "", 4: None, 5: "", 6: "\n\n"}
    assert linededup.drop_repeated_lines(tricky.texts(spark).limit(0)).collect() == []
    assert linededup.keep_bitmaps(tricky.texts(spark).limit(0)).collect() == []


def test_tricky_rows_keep_their_columns(spark):
    docs = tricky.documents(spark)
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))  # copies of row 7 share their id
    check(spark, [(r[0], r[1]) for r in tricky.TEXTS] + [(100, tricky.LONG), (101, "before\n" + tricky.LONG + "\nafter")])


def test_hashes_are_streamed_in_ranges(spark):
    lines = spark.range(1000).select(
        F.xxhash64("id").alias("h1"), F.xxhash64("id").alias("h2"), F.col("id").alias("doc"), F.col("id").alias("row"), F.lit(0).alias("pos")
    )
    plan = planned(linededup._later_lines(lines))
    assert "rangepartitioning(h1" in plan and "Python" not in plan and "Arrow" not in plan
    # The window works on the ranges as they are dealt: no other exchange of rows.
    assert plan.count("hashpartitioning") == 0 and "Window" in plan
