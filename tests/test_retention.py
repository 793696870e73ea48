import os

import pytest
from golden import envelope, gazetteer, payloads, posting

from vacancylens.plans import pipeline
from vacancylens.sources import lake, retention, warehouse


def serve(spark, path, store, day, batch=None):
    arrived = payloads(spark, envelope([posting(f"P{day}")], obtained=f"2022-01-0{day} 00:00:00"))
    pipeline.run_pipeline(spark, arrived, gazetteer(spark), path, store, insights=False, batch=batch)


def folders(path, table):
    return {f.removeprefix("run=") for f in os.listdir(os.path.join(path, table)) if f.startswith("run=")}


def parquet_files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


@pytest.fixture
def three_runs(spark, tmp_path):
    path, store = str(tmp_path / "wh"), str(tmp_path / "lake")
    for day in (1, 2, 3):
        serve(spark, path, store, day, batch=f"b-{day}")
    return path, store


def test_only_the_served_run_stays(spark, three_runs):
    path, _ = three_runs
    runs = [r.run for r in warehouse.published_runs(spark, path).orderBy("published").collect()]
    os.makedirs(f"{path}/documents/run=died")  # of a job that never published
    assert retention.expire_runs(spark, path, 0) == sorted([*runs[:2], "died"])
    for table in ("documents", "metadata", "postings", "salaries", "locations", "seniorities"):
        assert folders(path, table) == {runs[2]}
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["P3"]
    assert warehouse.read_served(spark, path, "salaries").count() == 1
    assert len(parquet_files(f"{path}/served")) == 1 and warehouse.is_published(spark, path, "b-3")
    assert retention.expire_runs(spark, path, 0) == []


def test_a_reader_opened_before_keeps_working(spark, three_runs):
    path, store = three_runs
    _, opened = warehouse.read_documents(spark, path)
    serve(spark, path, store, 4)
    # Out of use for a moment only.
    assert retention.expire_runs(spark, path, 3600) == []
    assert [r.id for r in opened.collect()] == ["P3"]
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["P4"]
    assert len(parquet_files(f"{path}/served")) == 1 and warehouse.published_runs(spark, path).count() == 4


def test_the_last_published_run_stays_whatever_its_snapshot(spark, three_runs):
    path, store = three_runs
    pipeline.replay(spark, store, "1640995200_nofluffjobs", gazetteer(spark), path, insights=False)
    assert len(retention.expire_runs(spark, path, 0)) == 3
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["P1"]


def test_nothing_to_expire(spark, tmp_path):
    assert retention.expire_runs(spark, str(tmp_path / "none"), 0) == []
    assert retention.compact_lake(spark, str(tmp_path / "none"), 0) is None


def contents(spark, store):
    heads = {(r.key, r.document, r.n_postings) for r in lake.read_heads(spark, store).collect()}
    postings = sorted((r.key, r.pos, r.id) for r in lake.read_postings(spark, store).collect())
    return heads, postings, sorted(r.payload for r in lake.read_lake(spark, store).collect())


def test_a_compacted_lake_holds_the_same(spark, tmp_path):
    store = str(tmp_path / "lake")
    days = [envelope([posting(f"{d}-{i}") for i in range(d)], obtained=f"2022-01-{d:02} 00:00:00") for d in range(1, 9)]
    for text in [*days, days[0], envelope([], obtained="2022-02-01 00:00:00"), envelope([posting("other")], obtained="2022-01-01 00:00:00")]:
        pipeline.archive(payloads(spark, text), store)
    before = contents(spark, store)
    assert len(before[0]) == 10 and len(before[1]) == 37
    opened = lake.load_postings(spark, store, "1641340800_nofluffjobs").postings
    merged = retention.compact_lake(spark, store, 3600)
    assert contents(spark, store) == before and opened.count() == 5
    assert {r.batch for r in lake.read_heads(spark, store).collect()} == {merged}
    # The batches it replaced are removed by a later call.
    assert len(os.listdir(f"{store}/heads")) > 1
    assert retention.compact_lake(spark, store, 0) is None
    for table in ("heads", "postings", "payloads"):
        assert [f for f in os.listdir(f"{store}/{table}") if f.startswith("batch=")] == [f"batch={merged}"]
    assert contents(spark, store) == before
    for key in ("1641340800_nofluffjobs", "1643673600_nofluffjobs"):
        assert len(lake.load_postings(spark, store, key).head.files) == 1
    assert lake.load_postings(spark, store, "1640995200_nofluffjobs").postings.count() == 1
