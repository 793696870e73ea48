import pytest
from plantext import planned
from pyspark.sql import functions as F

from vacancylens.operators import contracts
from vacancylens.plans import tables


def salaries(spark, *rows):
    return spark.createDataFrame(rows, "id string, contract_type string, salary_min string, salary_max double, salary_mean double")


GOOD = ("a", "B2B", "1", 2.0, 1.5)


def broken(df, contract):
    return {(r.column_name, r.rule): r.n for r in contracts.validate(df, contract)[1].collect()}


def test_good_table_is_coerced(spark):
    table, violations = contracts.validate(salaries(spark, GOOD), contracts.SALARIES)
    assert dict(table.dtypes)["salary_min"] == "double" and violations.isEmpty()
    assert contracts.require(salaries(spark, GOOD), contracts.SALARIES).first().salary_min == 1.0


def test_nan_is_missing(spark):
    nan = float("nan")
    assert broken(salaries(spark, GOOD, ("b", "B2B", "NaN", nan, nan)), contracts.SALARIES) == {
        ("salary_max", "not_null"): 1,
        ("salary_mean", "not_null"): 1,
        ("salary_min", "not_null"): 1,
    }
    places = spark.createDataFrame([("a", "x", nan, 5.0)], "id string, city string, lat double, lon double")
    assert broken(places, contracts.LOCATIONS) == {("lat", "not_null"): 1}


def test_every_rule_reports(spark):
    df = salaries(spark, GOOD, ("a", None, "-1", -2.0, 1.0), ("b", "B2B", "x", None, 0.0))
    assert broken(df, contracts.SALARIES) == {
        ("id", "unique"): 2,
        ("contract_type", "not_null"): 1,
        ("salary_min", "at_least"): 1,
        ("salary_min", "coercible"): 1,
        ("salary_max", "at_least"): 1,
        ("salary_max", "not_null"): 1,
    }
    with pytest.raises(contracts.ContractViolation, match="contract_type not_null"):
        contracts.require(df, contracts.SALARIES)


def test_postings_contract_reads_epoch_millis(spark):
    df = spark.sql(
        "SELECT 'a' AS id, 'n' AS name, 1640995200123L AS posted, '' AS title, '' AS technology, '' AS category, '' AS url, true AS remote, 1 AS other"
    )
    table = contracts.require(df, contracts.POSTINGS)
    assert table.select(F.date_format("posted", "yyyy-MM-dd")).first()[0] == "2022-01-01"
    assert "other" in table.columns


def test_location_bounds(spark):
    df = spark.createDataFrame([("a", "x", 90.0, 180.0), ("a", "x", -90.1, 180.1)], "id string, city string, lat double, lon double")
    assert broken(df, contracts.LOCATIONS) == {("lat", "at_least"): 1, ("lon", "at_most"): 1}


def test_schema_is_checked_before_any_data(spark):
    with pytest.raises(contracts.ContractViolation, match="absent"):
        contracts.validate(spark.range(1), contracts.SENIORITIES)
    with pytest.raises(contracts.ContractViolation, match="wrong types"):
        contracts.validate(spark.sql("SELECT 1 AS id, 'a' AS seniority"), contracts.SENIORITIES)


def test_empty_table_is_an_error(spark):
    with pytest.raises(RuntimeError):
        contracts.require_rows(spark.range(0), "documents")


DOCS = (
    "id string, name string, posted string, title string, technology string, category string, url string, remote boolean, "
    "contract_type string, salary_min double, salary_max string, salary_mean double, "
    "city array<struct<city:string,lat:double,lon:double>>, seniority array<string>"
)


def documents(spark):
    def doc(id, posted="2022-01-01", remote=True, contract="B2B", low=1.0, high="2", mean=1.5, city=((("x", 1.0, 2.0),)), seniority=("Mid",)):
        return (id, "n", posted, "t", "T", "C", "u", remote, contract, low, high, mean, None if city is None else list(city), None if seniority is None else list(seniority))

    nan = float("nan")
    rows = [
        doc("a"), doc("a", posted="soon"), doc("b", remote=None, contract=None, low=-1.0), doc(None, high="much", mean=nan),
        doc(None, city=[("x", 91.0, -181.0), ("y", None, 1.0), (None, 1.0, 1.0), ("z", nan, 1.0)]), doc("c", city=None, seniority=None),
        doc("d", city=[], seniority=[]), doc("e", seniority=["Mid", None, None], city=[("x", -91.0, 1.0), ("x", -92.0, 181.0)]), doc("f", posted=None),
        doc("a", high="-5"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def as_counts(violations):
    return {(r.table_name, r.column_name, r.rule): r.n for r in violations.collect()}


def test_one_pass_over_documents_finds_what_the_tables_break(spark):
    docs = documents(spark)
    by_table = {}
    for build, contract in tables.TABLES.values():
        by_table |= as_counts(contracts.validate(build(docs), contract)[1])
    assert as_counts(tables.all_violations(docs)) == by_table and len(by_table) > 14
    assert as_counts(tables.all_violations(docs.where("id = 'f'"))) == {}
    assert as_counts(tables.all_violations(docs.limit(0))) == {}


def test_contracts_take_one_scan_and_one_exchange_by_id(spark, tmp_path):
    path = str(tmp_path / "t")
    documents(spark).write.parquet(path)
    plan = planned(tables.all_violations(spark.read.schema(DOCS).parquet(path)))
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1 and "Generate" not in plan.replace("Generate inline", "")


def test_rules_are_counted_on_the_write(spark, tmp_path):
    good, path = documents(spark).where("id = 'f'"), str(tmp_path / "t")
    observed = tables.ObservedContracts(good)
    observed.documents.write.parquet(path)
    observed.require(spark.read.parquet(path))
    docs = documents(spark)
    observed = tables.ObservedContracts(docs)
    observed.documents.write.parquet(f"{path}2")
    with pytest.raises(contracts.ContractViolation) as error:
        observed.require(spark.read.parquet(f"{path}2"))
    told = {f"{t}.{c} {r} ({n} rows)" for (t, c, r), n in as_counts(tables.all_violations(docs)).items()}
    assert set(str(error.value).split(", ")) == told
