"""Rows that operators must take: nulls, empty and long texts, copies, odd columns."""

LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + ".\n" + "x" * 300_000

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the old house.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", "b"),
    (4, "  \n\t ", None, None),
    (5, "!!! 123 ???", "de", "b"),
    (6, LONG, "en", "b"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft davon.", "de", "c"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft davon.", "de", "c"),
    (8, "word", "en", None),
    (9, "漢字 かな   é́ \x00 ß İ", None, "c"),
    (None, "A row without an id has a text all the same, with some more words in it.", "en", "a"),
]
#: Other columns, with names that operators might use themselves.
EXTRA = "key string, n long, `a.b` int, text_key string, rep double, block string, component_id long, _rest string, `end` int"
EXTRA_ROW = ("k", 5, 1, "t", 0.5, "b", 77, "r", 3)
SCHEMA = f"doc_id long, text string, lang string, source string, {EXTRA}"


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(*r, *EXTRA_ROW) for r in rows], SCHEMA)


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string")
