import oracle
import tricky

import __spark_entry__ as entry
from vacancylens.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"
MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?\n\nI need   help."),
    (1, 1, "assistant", "On Monday X wrote:\n> Hello there.\n> How are you?\n\nFine, thanks."),
    (1, 2, "user", "> Fine, thanks.\n\nGreat.\n>> i need help."),
    (1, 3, "user", "new topic"),
    (1, 4, "user", "> > Hello there.\n> nothing known\nok"),
    (1, 5, "assistant", ">> Fine, thanks.\n> Great.\n\nStill here\n> not known\nthe end"),
    (1, 6, "user", "> new topic\nyes"),
    (2, 0, None, None),
    (2, 1, "user", "> Hello there.\nother conversation"),
    (3, 0, "user", "He wrote:\nno quote here"),
    (3, 1, "user", "a\r\n > He wrote:\r\n >no quote here\r\nb"),
    (None, 1, "x", "> q"),
]


def linked(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return quotes.linked_conversations(frame)


def test_threads_and_texts(spark):
    got = {(r.conv_id, r.turn): r for r in linked(spark, MESSAGES).collect()}
    assert {k: (r.thread, r.parent) for k, r in got.items() if k[0] == 1} == {
        (1, 0): (0, None), (1, 1): (0, 0), (1, 2): (0, 1), (1, 3): (3, None),
        (1, 4): (0, 0), (1, 5): (0, 2), (1, 6): (3, 3),
    }
    assert got[1, 1].text == "Fine, thanks."
    assert got[1, 5].text == "Still here\nthe end" and (got[1, 5].n_passages, got[1, 5].n_linked) == (3, 2)
    assert got[2, 1].parent is None and got[2, 1].n_linked == 0 and got[2, 0].text == ""
    assert got[3, 0].text == "He wrote:\nno quote here" and (got[3, 1].parent, got[3, 1].text) == (0, "a\nb")
    assert got[1, 3].formatted == "<|user|>\nnew topic\n<|end|>\n" and got[2, 0].role == "unknown"
    assert got[None, 1].text == "" and got[None, 1].parent is None


def test_nested_levels_find_their_messages(spark):
    links = quotes.quote_links(spark.createDataFrame(MESSAGES[:-1], SCHEMA))
    got = {(r.turn, r.level, r.source) for r in links.filter("conv_id = 1").collect()}
    assert got == {(1, 1, 0), (2, 1, 1), (2, 2, 0), (4, 2, 0), (5, 2, 1), (5, 1, 2), (6, 1, 3)}


def test_long_chain_and_hot_line(spark):
    chain = [(1, 0, "u", "message 0")] + [(1, k, "u", f"> message {k - 1}\nmessage {k}") for k in range(1, 40)]
    rows = linked(spark, chain).collect()
    assert {r.thread for r in rows} == {0} and sorted(r.parent for r in rows if r.turn) == list(range(39))
    hot = [(5, k, "u", "> same line\nsame line" if k else "same line") for k in range(300)]
    got = linked(spark, hot)
    assert got.count() == 300 and {r.parent for r in got.collect() if r.turn} == {0}


def test_same_rows_as_its_sql(spark, tmp_path):
    spark.createDataFrame(MESSAGES + MESSAGES[:3], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    ours = entry.queries()["op6_quote_threads"](spark, str(tmp_path))
    assert oracle.spark_rows(ours) == oracle.duck_rows(con, entry.oracle_sql()["op6_quote_threads"])


def test_no_python_in_the_plan(spark):
    plan = linked(spark, MESSAGES)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_very_many_marks(spark):
    (row,) = linked(spark, [(1, 1, "u", ">" * 50_000 + " deep\nown")]).collect()
    assert (row.text, row.n_passages) == ("own", 1)


def test_empty_table_and_long_text(spark):
    assert linked(spark, MESSAGES).filter("false").count() == 0
    assert linked(spark, []).count() == 0
    (row,) = linked(spark, [(1, 1, "u", tricky.LONG + "\n> a\n" * 500)]).collect()
    assert row.n_passages >= 1 and row.text == tricky.LONG
