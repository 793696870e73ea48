import pytest
from golden import POSTINGS, gazetteer, posting, raw
from plantext import executed, planned
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.operators.bounded import measured_rows
from vacancylens.operators.places import lookup_places, measured_places
from vacancylens.plans import clean


@pytest.fixture(scope="module")
def cleaned(spark):
    rows = clean.clean(raw(spark), gazetteer(spark)).collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r for r in rows}


def test_columns_and_kept_ids(spark, cleaned):
    assert clean.clean(raw(spark), gazetteer(spark)).columns == fixed.DOCUMENT_COLUMNS
    # A posting whose first row is in a foreign currency is gone altogether.
    assert set(cleaned) == {p["id"] for p in POSTINGS} - {"EUR", "EURFIRST"}


def test_first_duplicate_wins(cleaned):
    assert cleaned["DUP"].title == "first" and cleaned["DUP"].salary_mean == 2


def test_mock_posting(cleaned):
    row = cleaned["MOCK"]
    assert row.remote is True and row.contract_type == "B2B" and row.technology == "SQL"
    assert (row.salary_min, row.salary_max, row.salary_mean) == (20000, 25000, 22500)
    assert [tuple(c) for c in row.city] == [("Warszawa", 52.23, 21.01), ("Gdynia", 54.52, 18.53), ("Białystok", 53.13, 23.16)]
    assert row.seniority == ["Senior", "Mid"] and row.posted == 1640995200123


def test_salaries_with_missing_ends(cleaned):
    assert (cleaned["NOFROM"].salary_min, cleaned["NOFROM"].salary_mean) == (None, 9000)
    assert cleaned["NOPAY"].salary_mean is None


def test_places(cleaned):
    assert cleaned["NOPLACE"].city == []
    assert [c.city for c in cleaned["NOCITY"].city] == ["Warszawa"]
    assert [tuple(c) for c in cleaned["FOREIGN"].city] == [(None, None, None), ("Warszawa", 52.23, 21.01), (None, None, None)]


def test_names(cleaned):
    shown = {k: (cleaned[k].technology, cleaned[k].category) for k in ("NODE", "REACT", "NET", "EMPTY", "NAN", "NULL")}
    assert shown == {
        "NODE": ("Node", "Business Analyst"),
        "REACT": ("JavaScript", "Ux/Ui"),
        "NET": (".Net", "Ż Ax"),
        "EMPTY": (None, "Dev Op S"),
        "NAN": (None, None),
        "NULL": (None, None),
    }
    assert cleaned["REACT"].title == "javascript"
    assert cleaned["UPPER"].contract_type == "B2b"


def test_order_of_input_partitions_does_not_matter(spark):
    def rows(n):
        return sorted(map(str, clean.clean(raw(spark).repartition(n), gazetteer(spark)).collect()))

    assert rows(1) == rows(8)


def test_cleaning_twice_keeps_one_row_per_id(spark):
    once = clean.drop_duplicates(raw(spark))
    assert sorted(map(str, clean.drop_duplicates(once).collect())) == sorted(map(str, once.collect()))


def test_single_steps(spark):
    df = raw(spark, [posting("A")])
    assert not set(fixed.UNWANTED_COLUMNS) & set(clean.drop_unwanted(df).columns)
    with pytest.raises(ValueError, match="renewed"):
        clean.drop_unwanted(df.drop("renewed"))
    assert clean.extract_remote(df).first().remote is True
    assert clean.extract_contract_type(df).first().contract_type == "b2b"
    located = clean.extract_locations(df, gazetteer(spark)).first()
    assert located.city[0].city == "Warszawa" and round(located.city[0].lat, 1) == 52.2


def test_null_ids_form_one_group(spark):
    df = raw(spark, [posting(None, title="a"), posting(None, title="b"), posting("X")])
    assert sorted((str(r.id), r.title) for r in clean.clean(df, gazetteer(spark)).collect()) == [
        ("None", "a"),
        ("X", "Database Developer"),
    ]


def test_ambiguous_alias_gives_one_place(spark):
    double = gazetteer(spark).union(gazetteer(spark).withColumn("city", F.concat("city", F.lit("2"))))
    found = clean.extract_locations(raw(spark, [posting("A")]), double).first().city
    assert [c.city for c in found] == ["Warszawa", "Gdynia", "Białystok"]


def test_lookup_adds_no_shuffle_to_a_deduplicated_table(spark, monkeypatch):
    monkeypatch.setattr(clean, "VALUE_PLACES", 0)  # the join; the other way is tested below
    places = gazetteer(spark)
    assert measured_places(places) == 5
    final = executed(clean.clean(raw(spark), places, max_places=measured_places(places)))
    assert final.count("Exchange hashpartitioning(id") == 1
    assert "WindowGroupLimit" in final


def test_large_gazetteer_is_not_broadcast(spark):
    assert measured_rows(spark.range(11), 10) is None
    names = spark.createDataFrame([(1, ["Warsaw", "Gdynia"])], "k int, place_names array<string>")
    plan = planned(lookup_places(names, gazetteer(spark), ["k"], max_places=10**9))
    assert "BroadcastHashJoin" not in plan
    assert "BroadcastHashJoin" in planned(lookup_places(names, gazetteer(spark), ["k"], max_places=5))


def test_lookup_requires_no_places_column(spark):
    df = spark.createDataFrame([(1, ["Warsaw"]), (2, None), (3, [])], "k int, place_names array<string>")
    out = {r.k: [c.city for c in r.city] for r in lookup_places(df.withColumn("z", F.lit(0)), gazetteer(spark), ["k"]).collect()}
    assert out == {1: ["Warszawa"], 2: [], 3: []}


def test_places_in_place_equal_the_join(spark, monkeypatch):
    from vacancylens.operators import places

    monkeypatch.setattr(places, "BUCKETS", 3)
    rows = [(1, ["Warsaw", None, " BERLIN ", "Atlantis", "warsaw"]), (2, None), (3, []), (None, ["Gdynia"]), (None, ["Gdynia"])]
    df = spark.createDataFrame(rows, "k int, place_names array<string>").withColumn("z", F.lit("z"))
    double = gazetteer(spark).union(gazetteer(spark).withColumn("city", F.concat("city", F.lit("2"))))
    for countries in (None, ["Polska"]):
        mapped = places.map_places(df, double, countries=countries)
        joined = lookup_places(df.where("k is not null"), double, ["k"], countries=countries)
        assert dict(mapped.dtypes) == dict(joined.dtypes)
        found = {r.k: r.city for r in mapped.collect() if r.k is not None}
        assert found == {r.k: r.city for r in joined.collect()}
        assert [[c.city for c in r.city] for r in mapped.where("k is null").collect()] == [["Gdynia"], ["Gdynia"]]
    none = places.map_places(df, gazetteer(spark).limit(0))
    assert [c.city for c in none.where("k = 1").first().city] == [None] * 5


def test_a_small_gazetteer_neither_unfolds_nor_groups(spark):
    places_ = gazetteer(spark)
    plan = planned(clean.clean(raw(spark), places_, max_places=5))
    # Without the lines of the subquery that makes the table.
    main = "\n".join(line for line in plan.split("\n") if not line.lstrip().startswith(":"))
    assert not any(word in main for word in ("Generate", "Join", "Aggregate", "collect_list"))
    assert main.count("hashpartitioning(id") == 1 and "WindowGroupLimit" in main
