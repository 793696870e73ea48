import json
import os

import pytest
from golden import POSTINGS, envelope, gazetteer, payloads, posting
from pyspark.sql import functions as F

from vacancylens.operators import places
from vacancylens.plans import clean, pipeline
from vacancylens.sources import lake, snapshots, warehouse
from vacancylens.streaming.ingest import ingest_new_snapshots


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        file.write(text)


def one(id, obtained, **changes):
    return envelope([posting(id, **changes)], obtained=obtained)


def test_extract(spark):
    metadata, postings = snapshots.extract(payloads(spark, envelope()))
    assert metadata.count() == 1 and metadata.first().source_name == "nofluffjobs"
    rows = postings.orderBy("pos").collect()
    assert [r.id for r in rows] == [p["id"] for p in POSTINGS]
    assert {r.key for r in rows} == {"1638347405_nofluffjobs"}
    assert rows[0].salary["from"] == 20000 and rows[0].location.places[0].city == "Warsaw"


@pytest.mark.parametrize(
    "text, message",
    [
        (envelope(source="other"), "does not come from"),
        (envelope(total=3), "totalCount"),
        (json.dumps({"metadata": {"source_name": "nofluffjobs", "obtained_datetime": "2021-12-01 08:30:05"}, "raw_data": {"postings": []}}), "totalCount"),
        (json.dumps({"raw_data": {"postings": [], "totalCount": 0}}), "source_name"),
        (json.dumps({"metadata": {"source_name": "nofluffjobs", "obtained_datetime": "soon"}, "raw_data": {}}), "obtained_datetime"),
        (json.dumps({"metadata": {"source_name": "nofluffjobs", "obtained_datetime": "2021-12-01 08:30:05"}}), "raw_data"),
        ("not json", "source_name"),
    ],
)
def test_bad_snapshots_fail(spark, text, message):
    for table in snapshots.extract(payloads(spark, text)):
        with pytest.raises(Exception, match=message):
            table.select(F.lit(1)).collect()  # pruning does not skip the checks


def test_envelope_json_keeps_null_fields(spark):
    parsed = snapshots.read_snapshot(payloads(spark, envelope([posting("A")])))
    text = parsed.select(
        snapshots.to_envelope_json(F.col("source_name"), F.col("obtained_datetime"), F.col("raw_data"))
    ).first()[0]
    again = json.loads(text)
    assert again["metadata"] == {"source_name": "nofluffjobs", "obtained_datetime": "2021-12-01 08:30:05"}
    assert set(again) == {"metadata", "raw_data"} and again["raw_data"]["totalCount"] == 1
    assert again["raw_data"]["postings"][0]["referralBonus"] is None


def test_nan_tokens_are_read_as_missing(spark):
    nan = float("nan")
    odd = posting("A", referralBonus=nan, referralBonusCurrency=nan, title=nan, salary={"from": nan, "to": 5, "type": "b2b", "currency": "PLN"})
    text = envelope([odd, posting("B")])
    assert "NaN" in text
    _, postings = snapshots.extract(payloads(spark, text))
    rows = {r.id: r for r in clean.clean(postings, gazetteer(spark)).collect()}
    assert (rows["A"].title, rows["A"].salary_min, rows["A"].salary_mean) == (None, None, 5.0)
    assert rows["B"].salary_mean == 22500


def test_landing_wraps_raw_responses(spark, tmp_path):
    raw = json.loads(envelope([posting("A")]))["raw_data"]
    land(tmp_path / "in", "a.json", json.dumps(raw, indent=1))
    os.utime(tmp_path / "in" / "a.json", (1638347405, 1638347405))
    metadata, postings = snapshots.extract(snapshots.read_landing(spark, str(tmp_path / "in")))
    assert postings.first().key == "1638347405_nofluffjobs" and postings.first().id == "A"


def test_whole_files_and_lines(spark, tmp_path):
    land(tmp_path / "f", "a.json", json.dumps(json.loads(one("A", "2021-12-01 08:30:05")), indent=2))
    land(tmp_path / "l", "b.json", one("A", "2021-12-01 08:30:05") + "\n" + one("B", "2021-12-02 08:30:05") + "\n")
    assert snapshots.read_archive(spark, str(tmp_path / "f")).count() == 1
    assert snapshots.extract(snapshots.read_archive(spark, str(tmp_path / "l"), lines=True))[1].count() == 2


def test_lake_keeps_every_document_and_reads_the_last_of_a_key(spark, tmp_path):
    path = str(tmp_path / "lake")
    pipeline.archive(payloads(spark, one("A", "2021-12-01 08:30:05"), one("B", "2021-12-02 08:30:05")), path)
    for _ in range(2):
        pipeline.archive(payloads(spark, one("C", "2021-12-01 08:30:05")), path)
    assert lake.read_lake(spark, path).count() == 3
    stored = lake.load_archived(spark, path, "1638347405_nofluffjobs")
    assert json.loads(stored.first().payload)["raw_data"]["postings"][0]["id"] == "C"
    assert stored.first().key == "1638347405_nofluffjobs"
    with pytest.raises(KeyError):
        lake.load_archived(spark, path, "1_nofluffjobs")
    with pytest.raises(KeyError):
        lake.load_archived(spark, path, "1_odd name")


def test_lake_last_file_of_a_batch_wins(spark, tmp_path):
    path = str(tmp_path / "lake")
    same = "2021-12-01 08:30:05"
    pipeline.archive(payloads(spark, one("A", same), one("B", same)), path)
    stored = lake.load_archived(spark, path, "1638347405_nofluffjobs").collect()
    assert len(stored) == 1 and '"B"' in stored[0].payload
    assert lake.read_lake(spark, path).count() == 2


@pytest.mark.parametrize("with_lake", [True, False])
def test_one_document_of_a_key_is_served(spark, tmp_path, with_lake):
    path, store = str(tmp_path / "wh"), str(tmp_path / "lake") if with_lake else None
    same = "2021-12-01 08:30:05"
    both = payloads(spark, one("A", same), one("B", same))
    pipeline.run_pipeline(spark, both, gazetteer(spark), path, store, relational=False, insights=False)
    metadata, documents = warehouse.read_documents(spark, path)
    assert metadata.count() == 1 and [r.id for r in documents.collect()] == ["B"]


@pytest.mark.parametrize("files", [1, 3])
def test_responses_of_one_second_are_all_archived(spark, tmp_path, files):
    landing, path, store, mark = (str(tmp_path / n) for n in ("in", "wh", "lake", "mark"))
    raw = [json.dumps(json.loads(one(i, "2021-12-01 08:30:05"))["raw_data"]) for i in "ABC"]
    for n in range(files):
        land(landing, f"{n}.json", "\n".join(raw if files == 1 else [raw[n]]))
        os.utime(os.path.join(landing, f"{n}.json"), (1638347405, 1638347405))
    ingest_new_snapshots(
        spark, landing, gazetteer(spark), path, store, mark, lines=True, raw=True, relational=False, insights=False
    ).awaitTermination()
    kept = snapshots.extract(lake.read_lake(spark, store).select("payload"))[1]
    assert sorted(r.id for r in kept.collect()) == ["A", "B", "C"]
    assert warehouse.read_documents(spark, path)[1].count() == 1


GOOD = [p for p in POSTINGS if p["id"] in ("MOCK", "DUP", "NODE", "REACT", "FOREIGN", "NOPLACE")]


def test_pipeline_serves_the_newest(spark, tmp_path):
    path, store = str(tmp_path / "wh"), str(tmp_path / "lake")
    new, old = envelope(GOOD), envelope([posting("OLD")], obtained="2020-01-01 00:00:00")
    known = gazetteer(spark)
    with pytest.raises(RuntimeError):
        warehouse.read_documents(spark, path)
    key = pipeline.run_pipeline(spark, payloads(spark, new, old), known, path, store)
    assert key == "1638347405_nofluffjobs" and lake.read_lake(spark, store).count() == 2
    # An older snapshot that arrives later is archived, not served.
    assert pipeline.run_pipeline(spark, payloads(spark, old), known, path) == key
    metadata, documents = warehouse.read_documents(spark, path)
    assert metadata.count() == 1
    assert {r.id for r in documents.collect()} == {p["id"] for p in GOOD}
    served = {t: warehouse.read_served(spark, path, t) for t in ("postings", "salaries", "locations", "seniorities")}
    assert {t: df.count() for t, df in served.items()} == {"postings": 6, "salaries": 6, "locations": 13, "seniorities": 12}
    assert dict(served["postings"].dtypes)["posted"] == "timestamp"

    assert warehouse.read_served(spark, path, "insight_remote_share").count() == 2
    assert warehouse.read_served(spark, path, "insight_category_technology_nodes").columns == ["node_id", "label"]
    # Replay of the archived old snapshot takes effect, insights included.
    pipeline.replay(spark, store, "1577836800_nofluffjobs", known, path)
    assert warehouse.served_snapshot(spark, path).key == "1577836800_nofluffjobs"
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["OLD"]
    assert warehouse.read_served(spark, path, "insight_remote_share").count() == 1


def test_large_gazetteer_is_cut_to_the_places_in_use(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(places, "BROADCAST_PLACES", 4)
    _, postings = snapshots.extract(payloads(spark, envelope(GOOD)))
    known, most = pipeline._small_gazetteer(gazetteer(spark), postings)
    assert most == 4 and {r.alias for r in known.collect()} == {"Warsaw", "Gdynia", "Białystok", "Berlin"}
    pipeline.run_pipeline(spark, payloads(spark, envelope(GOOD)), gazetteer(spark), str(tmp_path))
    assert warehouse.read_served(spark, str(tmp_path), "locations").count() == 13


def test_sink_gets_the_five_tables(spark, tmp_path):
    given = {}
    known = gazetteer(spark)
    pipeline.run_pipeline(
        spark, payloads(spark, envelope(GOOD)), known, str(tmp_path), relational=False,
        sink=lambda tables: given.update({name: table.count() for name, table in tables.items()}),
    )
    assert given == {"metadata": 1, "postings": 6, "salaries": 6, "locations": 13, "seniorities": 12}


def test_failed_run_leaves_the_served_tables(spark, tmp_path):
    path = str(tmp_path / "wh")
    known = gazetteer(spark)
    pipeline.run_pipeline(spark, payloads(spark, envelope(GOOD)), known, path)
    broken = envelope([posting("X", salary={"from": None, "to": None, "type": "b2b", "currency": "PLN"})], obtained="2022-01-01 00:00:00")
    with pytest.raises(Exception, match="salary_mean"):
        pipeline.run_pipeline(spark, payloads(spark, broken), known, path)
    assert warehouse.read_documents(spark, path)[1].count() == 6
    # The same holds for a corrected document of the served key.
    again = envelope([posting("X", salary={"from": None, "to": None, "type": "b2b", "currency": "PLN"})])
    with pytest.raises(Exception, match="salary_mean"):
        pipeline.run_pipeline(spark, payloads(spark, again), known, path)
    assert {r.id for r in warehouse.read_documents(spark, path)[1].collect()} == {p["id"] for p in GOOD}


def test_streaming_ingests_each_file_once(spark, tmp_path):
    landing, path, store, mark = (str(tmp_path / n) for n in ("in", "wh", "lake", "mark"))
    known = gazetteer(spark)

    def run():
        query = ingest_new_snapshots(spark, landing, known, path, store, mark, maxFilesPerTrigger="1")
        query.awaitTermination()
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)  # batches of one file

    land(landing, "a.json", envelope(GOOD))
    land(landing, "b.json", one("OLD", "2020-01-01 00:00:00"))
    assert run() == 2
    assert warehouse.served_snapshot(spark, path)[1] == "1638347405_nofluffjobs"
    assert run() == 0
    land(landing, "c.json", one("NEW", "2022-01-01 00:00:00"))
    assert run() == 1
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["NEW"]
    assert lake.read_lake(spark, store).count() == 3


def test_streaming_of_raw_responses(spark, tmp_path):
    landing, path, store, mark = (str(tmp_path / n) for n in ("in", "wh", "lake", "mark"))
    land(landing, "a.json", json.dumps(json.loads(envelope(GOOD))["raw_data"]))
    os.utime(os.path.join(landing, "a.json"), (1638347405, 1638347405))
    ingest_new_snapshots(spark, landing, gazetteer(spark), path, store, mark, raw=True).awaitTermination()
    assert warehouse.served_snapshot(spark, path)[1] == "1638347405_nofluffjobs"
    assert lake.load_archived(spark, store, "1638347405_nofluffjobs").count() == 1


def test_posting_url(spark):
    df = spark.createDataFrame([("slug",)], "url string")
    assert snapshots.posting_url(df).first().page_url.endswith("/pl/job/slug")


def posting_lines(postings, obtained="2021-12-01 08:30:05", total=None, document=None, source="nofluffjobs"):
    head = {"metadata": {"source_name": source, "obtained_datetime": obtained}} | ({"document": document} if document else {})
    lines = [head | {"pos": i, "posting": p} for i, p in enumerate(postings)]
    lines.append(head | {"totalCount": len(postings) if total is None else total})
    return "\n".join(json.dumps(line) for line in lines) + "\n"


def test_posting_lines_equal_the_document(spark, tmp_path):
    land(tmp_path / "in", "a.json", posting_lines(POSTINGS))
    lines = snapshots.read_posting_lines(spark, str(tmp_path / "in"))
    by_line, by_document = str(tmp_path / "l"), str(tmp_path / "d")
    pipeline.archive(lines, by_line)
    pipeline.archive(payloads(spark, envelope()), by_document)
    key = "1638347405_nofluffjobs"
    columns = ["key", "pos", *snapshots.POSTING.names]
    one_way, other = (lake.load_postings(spark, p, key).postings.select(*columns).orderBy("pos").collect() for p in (by_line, by_document))
    assert list(map(str, one_way)) == list(map(str, other)) and len(other) == len(POSTINGS)
    plain = snapshots.extract(payloads(spark, envelope()))[1].select(*columns).orderBy("pos").collect()
    assert list(map(str, plain)) == list(map(str, other))
    with pytest.raises(KeyError, match="posting lines"):
        lake.load_archived(spark, by_line, key)


@pytest.mark.parametrize(
    "text, message",
    [
        (posting_lines([posting("A")], total=2), "totalCount"),
        (posting_lines([posting("A")]).split("\n")[0], "totalCount"),
        (posting_lines([posting("A")], obtained="soon"), "obtained_datetime"),
        (posting_lines([posting("A")], source="other"), "does not come from"),
        ('{"posting": {"id": "A"}, "pos": 0}', "source_name"),
        (posting_lines([posting("A")]).replace('"pos": 0, ', ""), "both pos and posting"),
    ],
)
def test_bad_posting_lines_leave_the_lake_as_it_was(spark, tmp_path, text, message):
    path = str(tmp_path / "lake")
    pipeline.archive(payloads(spark, one("OLD", "2020-01-01 00:00:00")), path)
    land(tmp_path / "in", "a.json", text)
    with pytest.raises(Exception, match=message):
        pipeline.archive(snapshots.read_posting_lines(spark, str(tmp_path / "in")), path)
    assert [r.key for r in lake.read_heads(spark, path).collect()] == ["1577836800_nofluffjobs"]
    assert lake.read_postings(spark, path).count() == 1


def test_documents_of_one_key_in_posting_lines(spark, tmp_path):
    path = str(tmp_path / "lake")
    land(tmp_path / "in", "a.json", posting_lines([posting("A")], document="one") + posting_lines([posting("B"), posting("C")], document="two"))
    pipeline.archive(snapshots.read_posting_lines(spark, str(tmp_path / "in")), path)
    assert {(r.document, r.n_postings) for r in lake.read_heads(spark, path).collect()} == {("one", 1), ("two", 2)}
    assert lake.load_postings(spark, path, "1638347405_nofluffjobs").postings.count() == 2


def test_one_large_snapshot_is_read_and_cleaned_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "POSTINGS_A_FILE", 100)
    land(tmp_path / "in", "a.json", posting_lines([posting(str(i)) for i in range(1000)]))
    path = str(tmp_path / "lake")
    pipeline.archive(snapshots.read_posting_lines(spark, str(tmp_path / "in")), path)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        snapshot = lake.load_postings(spark, path, "1638347405_nofluffjobs")
        assert len(snapshot.head.files) == 11  # 1000 postings and the line that announces them
        # Before the first exchange the rows are in as many tasks as there are to be had.
        assert snapshot.postings.rdd.getNumPartitions() >= 4
        cleaned = clean.clean(snapshot.postings, gazetteer(spark))
        assert cleaned.count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_read_by_key_opens_one_file_of_few(spark, tmp_path):
    path = str(tmp_path / "lake")
    texts = [one(str(day), f"2021-12-{day:02} 08:30:05") for day in range(1, 31)]
    pipeline.archive(payloads(spark, *texts).coalesce(3), path)
    assert len(lake._table(spark, path, "postings", lake.ARCHIVED_POSTING).inputFiles()) <= 3
    heads = {r.key: r for r in lake.read_heads(spark, path).collect()}
    assert len(heads) == 30 and all(len(h.files) == len(h.payload_files) == 1 for h in heads.values())
    for key in list(heads)[:3]:
        found = lake.load_postings(spark, path, key)
        assert len(found.postings.inputFiles()) == 1 and found.postings.count() == 1
        assert len(lake.load_archived(spark, path, key).inputFiles()) == 1


def test_a_batch_repeated_is_published_and_archived_once(spark, tmp_path):
    path, store = str(tmp_path / "wh"), str(tmp_path / "lake")
    batch, known = payloads(spark, envelope(GOOD)), gazetteer(spark)
    for _ in range(2):
        pipeline.run_pipeline(spark, batch, known, path, store, relational=False, insights=False, batch="s-0")
    assert warehouse.published_runs(spark, path).count() == 1
    assert lake._all_heads(spark, store).count() == 1
    # Died after archiving and before publishing: the repeated batch is served.
    pipeline.archive(payloads(spark, one("NEW", "2022-01-01 00:00:00")), store, batch="s-1")
    for _ in range(2):
        pipeline.run_pipeline(spark, payloads(spark, one("NEW", "2022-01-01 00:00:00")), known, path, store, relational=False, insights=False, batch="s-1")
    assert [r.id for r in warehouse.read_documents(spark, path)[1].collect()] == ["NEW"]
    assert warehouse.published_runs(spark, path).count() == 2 and lake._all_heads(spark, store).count() == 2


def test_the_stream_names_its_batches(spark, tmp_path):
    landing, path, store, mark = (str(tmp_path / n) for n in ("in", "wh", "lake", "mark"))
    for day in (1, 2):
        land(landing, f"{day}.json", posting_lines([posting(str(day))], obtained=f"2022-01-0{day} 00:00:00"))
        ingest_new_snapshots(spark, landing, gazetteer(spark), path, store, mark, relational=False, insights=False, posting_lines=True).awaitTermination()
    names = {r.batch for r in warehouse.published_runs(spark, path).collect()}
    assert {n.rpartition("-")[2] for n in names} == {"0", "1"} and len({n.rpartition("-")[0] for n in names}) == 1
