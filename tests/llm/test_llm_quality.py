import oracle
import tricky

import __spark_entry__ as entry
from vacancylens.llm import quality


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = oracle.spark_rows(entry.queries()["op8_host_quality"](spark, sf))
    assert got == oracle.duck_rows(oracle.connect(sf), entry.oracle_sql()["op8_host_quality"])


def rows_of(host, first, good, bad):
    text = " ".join(f"word{k}" for k in range(40))
    return [(first + k, text if k < good else "too short", "en", host) for k in range(good + bad)]


def test_a_bad_host_takes_its_rows_with_it(spark, tmp_path):
    rows = rows_of("bad", 0, 10, 90) + rows_of("fair", 1000, 60, 40) + rows_of("good", 2000, 200, 2)
    rows += rows_of("tiny", 3000, 1, 1) + rows_of(None, 4000, 50, 0)
    docs = tricky.documents(spark, rows)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert len(got) == len(rows)
    assert all(r.host_failed == (r.host == "bad") for r in got.values())
    assert not got[0].base_failed and not got[0].kept and got[1000].kept and got[4000].kept
    # Two rows say little: the host is judged nearly as all are.
    rates = {r.host: r.rate for r in quality.host_rates(quality.text_counts(docs)).collect()}
    assert rates["bad"] > 0.8 and rates["good"] < 0.05 and 0.2 < rates["tiny"] < 0.5
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    ours = entry.queries()["op8_host_quality"](spark, str(tmp_path))
    assert oracle.spark_rows(ours) == oracle.duck_rows(con, entry.oracle_sql()["op8_host_quality"])


def test_hosts_that_differ_by_chance_only_are_all_alike(spark):
    rows = [r for k in range(8) for r in rows_of(f"h{k}", 1000 * k, 50, 50)]
    hosts = quality.host_rates(quality.text_counts(tricky.documents(spark, rows))).collect()
    assert {round(r.rate, 3) for r in hosts} == {0.5}


def test_counts(spark):
    same = "one two three four five six seven eight nine"
    text = f"{same}\n{same}\n \n#a$ é&\n{same}\nx"
    got = quality.text_counts(tricky.documents(spark, [(1, text, "en", "a")])).first()
    assert (got.n_words, got.n_dup_lines, got.n_symbols, got.n_lines) == (30, 2, 3, 5)
    assert got.word_chars == len("".join(text.split()))
    words = text.split()
    grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    assert got.n_repeat_words == len({p for k, g in enumerate(grams) if grams.count(g) > 1 for p in range(k, k + 8)})


def test_odd_rows(spark):
    got = quality.judge(tricky.documents(spark)).collect()
    assert len(got) == len(tricky.TEXTS)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (2, 3, 4, 5, 8, 9))
    assert {(r.n_words, r.word_chars) for r in got if r.doc_id in (2, 3, 4)} == {(0, 0)}
    assert quality.judge(tricky.documents(spark, [])).count() == 0
