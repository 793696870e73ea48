"""Lines that an earlier document has too, with DataFrame functions only.

1. Every line has a key (white space at both ends stripped, A-Z as a-z), and
   every key of ``LEAST_CHARS`` code points or more a 128-bit hash. The hashes are
   stored with document and position; texts stay where they are.
2. A frequent-items sketch of fixed size names hashes that may hold many of the
   rows. Their first document is a minimum that is combined in each task before
   it is shuffled, so none of their rows is. Which hashes the sketch names decides
   how they are worked on and never the result.
3. All other hashes are dealt out by range and sorted by hash, document and
   position. The stream of a range carries the first document of the hash at hand;
   a row of a later document is a line to drop.
4. What leaves this is, for each document, a compressed bitmap: the runs of lines
   that stay. Texts meet it only when they are rewritten.

Only the smallest document id that holds a key keeps its lines with it, all of
them. A null text has one empty line. Rows without an id are not compared and keep
their lines. Rows that share an id are one document; each keeps its own text, and
equal rows fare alike. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.llm.frames import joined_with_text, split_off_text, stored

LEAST_CHARS = 10
SPACES = " \t\n\x0b\x0c\r"
#: Hashes that the sketch may name, and how many it follows at a time.
MOST_COMMON, FOLLOWED = 1000, 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _version(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_key(line: Column) -> Column:
    """What lines are compared by."""
    bare = F.trim(line, F.lit(SPACES))
    # Lowering of pure ASCII is one pass over bytes.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashed_lines(docs: DataFrame) -> DataFrame:
    """``h1, h2, doc, row, pos`` of every line that is long enough."""
    keys = F.transform(_split(F.col("text")), line_key)
    lines = docs.where("doc is not null").select("doc", _version(F.col("text")).alias("row"), F.posexplode(keys).alias("pos", "key"))
    first, second = F.xxhash64("key"), F.xxhash64(F.lit(1), F.col("key"))
    return lines.where(F.char_length("key") >= LEAST_CHARS).select(first.alias("h1"), second.alias("h2"), "doc", "row", "pos")


def _first_of_common(lines: DataFrame) -> DataFrame:
    """``h1, h2, first``: the first document of each hash that the sketch names."""
    named = lines.agg(F.expr(f"approx_top_k(h1, {MOST_COMMON}, {FOLLOWED})").alias("top"))
    named = named.select(F.explode("top.item").alias("h1"))
    rows = lines.join(F.broadcast(named), "h1", "left_semi")
    return rows.groupBy("h1", "h2").agg(F.min("doc").alias("first"))


def _later_lines(lines: DataFrame) -> DataFrame:
    """``doc, row, pos`` of the lines that a document before theirs holds."""
    common = stored(_first_of_common(lines), "common_lines")
    rest = lines.join(F.broadcast(common), ["h1", "h2"], "left_anti")
    stream = Window.partitionBy("h1", "h2").orderBy("doc", "row", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The window's partitions lie inside the ranges, so it needs no exchange of its own.
    ranged = rest.repartitionByRange("h1", "h2").withColumn("first", F.first("doc").over(stream))
    firsts = lines.join(F.broadcast(common), ["h1", "h2"])
    columns = ["doc", "row", "pos", "first"]
    return ranged.select(*columns).unionByName(firsts.select(*columns)).where("doc > first").drop("first")


def _runs_kept(n_lines: Column, dropped: Column) -> Column:
    """Runs ``(at, n)`` between the ascending dropped positions, empty ones left out."""
    cuts = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    starts = F.slice(cuts, F.lit(1), F.size(cuts) - 1)
    ends = F.slice(cuts, F.lit(2), F.size(cuts) - 1)
    runs = F.zip_with(starts, ends, lambda a, b: F.struct((a + 1).alias("at"), (b - a - 1).alias("n")))
    return F.filter(runs, lambda r: r["n"] > 0)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, n_lines, n_dropped, keep``, one row for each document.

    ``keep`` is a bitmap of the lines in run form: ascending ``(at, n)``, each a run
    of ``n`` lines that stay. ``row`` tells rows apart that share an id.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    lines = stored(_hashed_lines(narrow), "lines")
    drops = _later_lines(lines).groupBy("doc", "row").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    sizes = narrow.where("doc is not null").select("doc", _version(F.col("text")).alias("row"), F.size(_split(F.col("text"))).alias("n_lines"))
    sizes = sizes.groupBy("doc", "row").agg(F.max("n_lines").alias("n_lines"))
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return sizes.join(drops, ["doc", "row"], "left").select(
        F.col("doc").alias("doc_id"), "row", "n_lines", F.size(dropped).alias("n_dropped"), _runs_kept(F.col("n_lines"), dropped).alias("keep")
    )


def _kept_text(text: Column, keep: Column) -> Column:
    lines = _split(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["at"] + 1, r["n"]))), "\n")


def _met(rest: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``_rest, _lines, _dropped, _text`` from ``_rest, _doc, _text`` and the bitmaps."""
    keyed = rest.withColumn("_row", _version(F.col("_text")))
    marks = bitmaps.select("doc_id", "row", "n_lines", "n_dropped", "keep").toDF("_doc", "_row", "_n", "_lost", "_keep")
    met = keyed.join(marks, ["_doc", "_row"], "left")
    text = F.when(F.col("_lost") > 0, _kept_text(F.col("_text"), F.col("_keep"))).otherwise(F.col("_text"))
    sizes = F.coalesce("_n", F.size(_split(F.col("_text"))))
    return met.select("_rest", sizes.cast("long").alias("_lines"), F.coalesce("_lost", F.lit(0)).cast("long").alias("_dropped"), text.alias("_text"))


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row; nothing dropped leaves a null text null."""
    doc = F.col(id_col).cast("long")
    met = _met(docs.select(doc.alias("_rest"), doc.alias("_doc"), F.col(text_col).alias("_text")), bitmaps)
    return met.toDF("doc_id", "n_lines", "n_dropped", "text")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the lines that stay."""
    apart = split_off_text(docs, text_col)
    doc = F.col("_rest").getField(f"c{docs.columns.index(id_col)}").cast("long")
    return _met(apart.withColumn("_doc", doc), bitmaps).select(*joined_with_text(docs.columns, text_col))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`apply_bitmaps` with the bitmaps of ``docs`` themselves."""
    return apply_bitmaps(docs, stored(keep_bitmaps(docs, id_col, text_col), "bitmaps"), id_col, text_col)
