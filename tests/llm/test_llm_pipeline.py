import re
import shutil
import subprocess
import sys

import conftest
import oracle
import pytest
import tricky

import __spark_entry__ as entry
import corpus_pipeline
from vacancylens.llm import decontam, language, queries

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "surrogates", "best_fit_packing"]


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in queries.QUERIES) if m)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
    # Two more run operators 6 and 8 over what they derive from the given tables.
    assert {n for n in queries.QUERIES if not n.startswith("op")} == {"quoted_replies", "short_text_host"}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_equal_their_sql(spark, name):
    got = oracle.spark_rows(queries.QUERIES[name](spark, SF))
    assert got == oracle.duck_rows(oracle.connect(SF), queries.ORACLES[name])


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = corpus_pipeline.run(spark, SF).collect()
    kept = language.keep_known(docs, language.train(docs))
    first = {r.doc_id for r in corpus_pipeline.near_dedup(spark, kept, SF).collect()}
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {r.doc_id for r in decontam.contaminated(docs, benchmark).collect()}
    assert {r.doc_id for r in rows} == first - held
    assert len(first) >= 0.8 * docs.count()


def test_stages_take_odd_rows(spark):
    docs = tricky.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect() or [], docs.schema) if name != "best_fit_packing" else stage(spark, docs, SF)
    assert docs.count() >= 4


def test_entry_works_without_the_optional_part(tmp_path):
    shutil.copytree(f"{conftest.ROOT}/vacancylens", tmp_path / "vacancylens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{conftest.ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_the_optional_part():
    found = subprocess.run(["grep", "-rlE", r"vacancylens\.llm|from vacancylens import llm", f"{conftest.ROOT}/vacancylens", "--include=*.py"], capture_output=True, text=True)
    assert all("/vacancylens/llm/" in f for f in found.stdout.split())
