"""Insights against plain Python over the golden postings, repeated unevenly."""

import random
from collections import Counter, defaultdict

import pytest
from plantext import planned
from pyspark.sql import functions as F

from vacancylens.operators import distribution
from vacancylens.plans import cube, insights, profile, tables
from vacancylens.schemas import DOCUMENT

TECHNOLOGIES = ["Java", "JavaScript", "Python", "SQL", "PHP", ".Net", "AWS", "Go", "Scala", "C", None]
PLACES = [("Warszawa", 52.2, 21.0), ("Gdynia", 54.5, 18.5), ("Kraków", 50.1, 19.9), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        low, high = rng.choice([None, rng.randrange(0, 30000)]), rng.randrange(1000, 60000)
        mean = high if low is None else (low + high) / 2
        rows.append(
            (
                str(i), "n", 0, "t", rng.choices(TECHNOLOGIES, range(11, 0, -1))[0], rng.choice(["Backend", "Frontend", "Qa"]),
                "u", rng.random() < 0.4, rng.choice(["B2B", "Permanent", "B2b"]), None if low is None else float(low),
                float(high), float(mean), rng.choices(PLACES, [9, 3, 2, 1], k=rng.randrange(4)),
                rng.sample(["Junior", "Mid", "Senior", "Expert"], k=rng.randrange(3)),
            )
        )
    return rows, spark.createDataFrame(rows, DOCUMENT).repartition(6).cache()


C = {f.name: i for i, f in enumerate(DOCUMENT)}


def top(counter, n):
    return [k for k, _ in sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:n]]


def test_registry_holds_twelve_insights(docs):
    assert len(insights.INSIGHTS) == 15
    results = insights.all_insights(docs[1])
    assert all(df.count() > 0 for df in results.values())
    with pytest.raises(ValueError):
        insights.insight("technology_share")(lambda d: d)


def test_technology_share(docs):
    rows, df = docs
    count = Counter(r[C["technology"]] for r in rows if r[C["technology"]])
    best = top(count, 4)
    out = {r.technology: (r.n, r.share) for r in insights.technology_share(df, 4).collect()}
    total = sum(count[t] for t in best)
    assert out == {t: (count[t], count[t] / total) for t in best}


def test_seniority_share_counts_postings_without_level(docs):
    rows, df = docs
    count = Counter(s for r in rows for s in (r[C["seniority"]] or [None]))
    out = {r.seniority: r.n for r in insights.seniority_share(df).collect()}
    assert out == dict(count)


@pytest.mark.parametrize("level", [None, "Junior", "Senior"])
def test_salary_by_city(docs, level):
    rows, df = docs
    salaries = defaultdict(list)
    for r in rows:
        if level is None or level in r[C["seniority"]]:
            for city, _, _ in r[C["city"]]:
                if city:
                    salaries[city].append(r[C["salary_mean"]])
    best = top({c: len(v) for c, v in salaries.items()}, 2)
    out = {r.city: r for r in insights.salary_by_city(df, 2, level).collect()}
    assert set(out) == set(best)
    for city in best:
        assert out[city].job_counts == len(salaries[city])
        assert out[city].salary_mean == pytest.approx(sum(salaries[city]) / len(salaries[city]))
    kept = insights.salary_by_city_min_jobs(df, 100, level).collect()
    assert {r.city for r in kept} == {c for c, v in salaries.items() if len(v) > 100}


def test_histogram(docs):
    rows, df = docs
    count = Counter()
    for r in rows:
        if 0 < r[C["salary_mean"]] < 40000:
            count.update((s, int(r[C["salary_mean"]] // 1000 * 1000)) for s in r[C["seniority"]])
    out = insights.salary_histogram(df).collect()
    assert {(r.seniority, r.bin_start): r.n for r in out} == dict(count)
    order = ["Junior", "Mid", "Senior", "Expert"]
    assert [r.seniority for r in out] == sorted((r.seniority for r in out), key=order.index)


def test_technology_distribution_ranks_on_exploded_rows(docs):
    rows, df = docs
    weight = Counter()
    for r in rows:
        if r[C["technology"]]:
            weight[r[C["technology"]]] += max(len(r[C["seniority"]]), 1)
    best = top(weight, 3)
    count = Counter(
        (s, r[C["technology"]])
        for r in rows
        for s in r[C["seniority"]]
        if r[C["technology"]] in best and r[C["salary_mean"]] < 35000 and s != "Expert"
    )
    out = {(r.seniority, r.technology): r.n for r in insights.technology_salary_distribution(df, 3, more_than=40).collect()}
    assert out == {k: n for k, n in count.items() if n > 40}
    shape = insights.technology_salary_shape(df, 3).groupBy("seniority", "technology").agg(F.sum("n").alias("n"))
    assert {(r.seniority, r.technology): r.n for r in shape.collect()} == dict(count)


def test_contract_distribution_ranks_on_postings(docs):
    rows, df = docs
    best = top(Counter(r[C["technology"]] for r in rows if r[C["technology"]]), 3)
    count = Counter(
        (r[C["contract_type"]], r[C["technology"]])
        for r in rows
        if r[C["technology"]] in best and r[C["salary_mean"]] < 40000 and r[C["contract_type"]] != "B2b"
    )
    out = {(r.contract_type, r.technology): r.n for r in insights.contract_salary_distribution(df, 3).collect()}
    assert out == dict(count)
    assert sum(r.n for r in insights.contract_salary_shape(df, 3).collect()) == sum(count.values())


def test_salary_describe(docs):
    rows, df = docs
    real = [r for r in rows if r[C["salary_min"]] and r[C["salary_max"]] > r[C["salary_min"]] > 0]
    out = {r.statistic: r for r in profile.salary_describe(df).collect()}
    assert out["n"].salary_min == len(real)
    assert out["max"].salary_max == max(r[C["salary_max"]] for r in real)


def test_profile(docs):
    rows, df = docs
    tables_ = profile.data_profile(df)
    assert tables_["rows"].first().n_rows == len(rows)
    assert tables_["duplicates"].first().n_duplicates == 0
    assert {r.column_name: r.n_null for r in tables_["nulls"].collect()}["technology"] == sum(
        r[C["technology"]] is None for r in rows
    )


def test_tables(docs):
    rows, df = docs
    assert tables.locations_table(df).count() == sum(1 for r in rows for c in r[C["city"]] if c[0])
    assert tables.seniorities_table(df).count() == sum(max(len(r[C["seniority"]]), 1) for r in rows)
    assert tables.postings_table(df).columns == tables.fixed.POSTINGS_COLUMNS


def test_partitioning_of_the_input_does_not_matter(docs):
    def rows(name, n):
        def cell(value):
            return f"{value:.6f}" if isinstance(value, float) else str(value)

        found = insights.INSIGHTS[name](docs[1].repartition(n)).collect()
        return sorted(tuple(map(cell, row)) for row in found)

    for name in insights.INSIGHTS:
        assert rows(name, 1) == rows(name, 7), name


def shown(df):
    """Rows as text with numbers rounded, in any order."""

    def cell(value):
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    return sorted(tuple(cell(row[c]) for c in sorted(df.columns)) for row in df.collect())


@pytest.fixture(scope="module")
def odd_docs(spark, docs):
    """Documents with NaN, zero and negative salaries, missing lists and values."""
    nan = float("nan")
    base = docs[0][0]
    changes = [
        {"salary_mean": nan}, {"salary_mean": None}, {"salary_mean": 0.0}, {"salary_mean": -5.0}, {"salary_mean": 34999.99}, {"salary_mean": 35000.0},
        {"seniority": None}, {"seniority": []}, {"seniority": ["Mid", "Mid", None]}, {"city": None}, {"city": [("X", None, 1.0), ("X", 2.0, 2.0)]},
        {"id": None}, {"technology": None}, {"category": None}, {"remote": None}, {"contract_type": None},
    ]
    rows = [tuple(change.get(f.name, base[i]) for i, f in enumerate(DOCUMENT)) for change in changes * 3]
    return docs[1].unionByName(spark.createDataFrame(rows, DOCUMENT))


def test_insights_of_the_cube_equal_those_of_the_documents(docs, odd_docs):
    for given in (docs[1], odd_docs, docs[1].limit(0)):
        found = cube.insights_of_cube(cube.insight_cube(given).cache(), given)
        assert set(found) == set(insights.INSIGHTS)
        for name, query in insights.INSIGHTS.items():
            wanted = query(given)
            assert found[name].dtypes == wanted.dtypes, name
            assert shown(found[name]) == shown(wanted), name


def test_parameters_of_the_cube(docs):
    cells = cube.insight_cube(docs[1]).cache()
    assert shown(cube.category_technology_flow(cells, 2, 4, 60)) == shown(insights.category_technology_flow(docs[1], 2, 4, 60))
    assert shown(cube.technology_salary_shape(cells, 3, 20000)) == shown(insights.technology_salary_shape(docs[1], 3, 20000))
    assert shown(cube.salary_by_city(cells, 1, "Expert")) == shown(insights.salary_by_city(docs[1], 1, "Expert"))


def test_the_documents_are_scanned_twice_for_all_insights(spark, docs, tmp_path, monkeypatch):
    path, seen, parts = str(tmp_path / "d"), [], distribution._parts
    docs[1].write.parquet(path)
    given = spark.read.schema(DOCUMENT).parquet(path)
    assert planned(cube.insight_cube(given)).count("FileScan") == 1
    cube.insight_cube(given).write.parquet(f"{path}_cube")
    cells = spark.read.parquet(f"{path}_cube")
    monkeypatch.setattr(distribution, "_parts", lambda *a: seen.append(parts(*a)) or seen[-1])
    found = cube.insights_of_cube(cells, given)
    assert len(seen) == 1 and planned(seen[0]).count("technology#") > 0
    assert [planned(df).count(f"{path}]") for df in seen] == [1]
    assert all(f"{path}]" not in planned(df) for df in found.values())
