"""Quotation linking of messages, with DataFrame functions only.

1. A message's lines have a level: the number of ``>`` they begin with. Lines of
   level 0 without attributions are its own text; lines of one level that follow
   one another are a quoted passage.
2. A passage and its first line, in one form (lower case, single spaces), are
   hashed and joined with the hashes of own texts, paragraphs and lines of the
   same conversation. Each hash has one original, the first message with it, so a
   line that all messages have makes no pairs.
3. A message answers what its least quoted level comes from. It stands below the
   unquoting message at the end of that chain; the order ``(thread, turn)`` puts
   every answer after what it answers.

A conversation is never gathered: all joins are by conversation and turn or hash.
Null texts are empty. A null role is ``unknown``. Rows without a conversation or
turn are in no thread and keep their text. Repeated rows are formatted each. An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.llm.frames import stored

_QUOTED = r"^[ \t]*>[> \t]*"
#: Lines that name who is quoted, in some languages (fixed values).
ATTRIBUTION = r"(?i)^.{1,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$"
#: A chain of answers halves in each round; this is enough for any.
MOST_ROUNDS = 64


def one_form(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s]+", " "))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _QUOTED, 0), "[^>]", ""))


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")


def _has_quote(text: Column) -> Column:
    return text.rlike(rf"(?m){_QUOTED}")


def own_text(text: Column) -> Column:
    """A message without quoted lines, and without attributions if it quotes."""
    kept = F.filter(_lines(text), lambda x: (_level(x) == 0) & ~x.rlike(ATTRIBUTION))
    return F.when(_has_quote(text), F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")).otherwise(text)


def passages(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, level, part, form, first_form`` of quoted passages."""
    quoting = messages.filter(_has_quote(F.col("text")))
    lines = quoting.select(
        "conv_id", "turn", F.xxhash64("text").alias("row"), F.posexplode(_lines(F.col("text"))).alias("at", "line")
    ).distinct()
    lines = lines.withColumn("level", _level(F.col("line")))
    message = Window.partitionBy("conv_id", "turn", "row").orderBy("at")  # one message's lines
    before = F.lag("level", 1, -1).over(message)
    turned = lines.withColumn("turned", (F.col("level") != before).cast("int"))
    lines = turned.withColumn("part", F.sum("turned").over(message))
    body = F.struct("at", F.regexp_replace("line", _QUOTED, "").alias("body"))
    grouped = lines.filter("level > 0").groupBy("conv_id", "turn", "row", "level", "part").agg(F.sort_array(F.collect_list(body)).alias("b"))
    bodies = F.filter(F.transform("b", lambda x: one_form(x["body"])), lambda x: x != "")
    formed = grouped.withColumn("bodies", bodies).filter(F.size("bodies") > 0)
    return formed.select(
        "conv_id", "turn", "level", "part",
        F.array_join("bodies", " ").alias("form"), F.element_at("bodies", 1).alias("first_form"),
    )


def _digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def originals(messages: DataFrame) -> DataFrame:
    """``conv_id, digest, source``: the first turn whose own text has a passage."""
    own = messages.select("conv_id", "turn", own_text(F.col("text")).alias("own"))
    units = F.concat(F.array("own"), F.split("own", r"\n\s*\n"), _lines(F.col("own")))
    units = F.array_distinct(F.filter(F.transform(units, one_form), lambda x: x != ""))
    hashed = own.select("conv_id", "turn", F.explode(units).alias("form"))
    return hashed.groupBy("conv_id", _digest(F.col("form")).alias("digest")).agg(F.min("turn").alias("source"))


def quote_links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, level, part, source``: the message that each passage is from."""
    quoted = passages(messages)
    tried = F.array(
        F.struct(F.lit(1).alias("rank"), _digest(F.col("form")).alias("digest")),
        F.struct(F.lit(2).alias("rank"), _digest(F.col("first_form")).alias("digest")),
    )
    keys = quoted.select("conv_id", "turn", "level", "part", F.explode(tried).alias("t"))
    keys = keys.select("conv_id", "turn", "level", "part", "t.rank", "t.digest")
    # Only conversations with quotes have passages to look for.
    wanted = keys.select("conv_id").distinct()
    sources = originals(messages.join(wanted, "conv_id", "left_semi"))
    found = keys.join(sources, ["conv_id", "digest"]).filter("source < turn")
    best = F.min(F.struct("rank", "source")).alias("best")
    return found.groupBy("conv_id", "turn", "level", "part").agg(best).select("conv_id", "turn", "level", "part", "best.source")


def _threads(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, parent, thread``: the end of each chain, by doubling steps."""
    now = stored(parents.withColumn("thread", F.col("parent")), "threads")
    for _ in range(MOST_ROUNDS):
        onward = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("beyond"))
        stepped = now.join(onward, ["conv_id", "thread"], "left")
        moved = stored(
            stepped.select("conv_id", "turn", "parent", F.coalesce("beyond", "thread").alias("thread"), F.col("beyond").isNotNull().alias("moved")),
            "threads",
        )
        now = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return now
    raise RuntimeError("a chain of answers did not end")


def linked_conversations(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per message ``conv_id, thread, turn, parent, role, text, formatted, n_passages, n_linked``.

    ``text`` is without quotes; in the order of ``thread`` and ``turn`` the rows of a
    conversation read as it was answered.
    """
    messages = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    placed = messages.filter("conv_id is not null and turn is not null")
    links = stored(quote_links(placed), "links")
    # The least level that has an original; of its passages the first.
    answer = F.min(F.struct("level", "part", "source")).alias("answer")
    parents = links.groupBy("conv_id", "turn").agg(answer, F.count("*").alias("n_linked"))
    counts = parents.select("conv_id", "turn", "n_linked")
    threads = _threads(parents.select("conv_id", "turn", F.col("answer.source").alias("parent")))
    quoted = passages(placed).groupBy("conv_id", "turn").agg(F.count("*").alias("n_passages"))
    notes = stored(quoted.join(counts, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left"), "notes")
    own = own_text(F.col("text"))
    joined = messages.join(notes, ["conv_id", "turn"], "left").withColumn("own", own)
    return joined.select(
        "conv_id",
        F.coalesce("thread", "turn").alias("thread"),
        "turn",
        "parent",
        "role",
        F.col("own").alias("text"),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "own", F.lit("\n<|end|>\n")).alias("formatted"),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
