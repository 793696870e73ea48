import math
import random
import statistics

import pytest
from plantext import executed, planned
from pyspark.sql import functions as F

from vacancylens.operators import counts, distribution, filters, flatten, flow, groups, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.uniform(-50, 50000), i) for i in range(3000)]
    rows += [(None, 5.0, 3000), ("k1", None, 3001), ("only", 7.0, 3002)]
    return rows, spark.createDataFrame(rows, "k string, v double, i int").repartition(8)


def quantile(values, q):
    values, place = sorted(values), q * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


def test_distribution_matches_brute_force(skewed):
    rows, df = skewed
    found = {r.k: r for r in distribution.distribution(df, ["k"], "v").collect()}
    assert set(found) == {r[0] for r in rows}
    for key, row in found.items():
        values = [v for k, v, _ in rows if k == key and v is not None]
        assert row.n == len(values) and row.min == min(values) and row.max == max(values)
        assert row.mean == pytest.approx(statistics.fmean(values))
        assert row.stddev == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)
        for name, q in distribution.QUARTILES.items():
            assert row[name] == pytest.approx(quantile(values, q)), (key, name)


def test_distribution_of_equal_and_few_values(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(6.0,)], "v double")
    row = distribution.distribution(df, [], "v", {"p10": 0.1, "p95": 0.95, "p0": 0.0, "p100": 1.0}).first()
    assert (row.n, row.p10, row.p0, row.p100) == (10, 5.0, 5.0, 6.0) and row.p95 == pytest.approx(5.55)
    pair = distribution.distribution(spark.createDataFrame([(1.0,), (4.0,)], "v double"), [], "v").first()
    assert (pair.p25, pair.p50, pair.p75) == (1.75, 2.5, 3.25)


def test_distribution_leaves_out_small_groups(skewed):
    _, df = skewed
    assert [r.k for r in distribution.distribution(df, ["k"], "v", more_than=500).collect()] == ["hot"]


def rounds(monkeypatch):
    """The plans of the rounds that split bins."""
    seen, parts = [], distribution._parts
    monkeypatch.setattr(distribution, "_parts", lambda *given: seen.append(parts(*given)) or seen[-1])
    return seen


def test_distribution_reads_its_input_twice_only(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "t"), rounds(monkeypatch)
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v")).write.parquet(path)
    df = distribution.distribution(spark.read.parquet(path), ["k"], "v", max_groups=3)
    assert [planned(round).count("FileScan") for round in seen] == [2] and "BroadcastHashJoin" in planned(seen[0])
    assert df.count() == 3


@pytest.mark.parametrize("sub_bins", [2, 7, 1 << 16])
def test_crowded_bins_are_split_until_a_value_is_known(spark, monkeypatch, sub_bins):
    """All values of a group in one bin, half of them in the least part of it."""
    monkeypatch.setattr(distribution, "SUB_BINS", sub_bins)
    seen = rounds(monkeypatch)
    rng = random.Random(sub_bins)
    close = [1e6 + rng.random() * 1e-6 for _ in range(300)] + [1e6 + rng.random() for _ in range(299)] + [1e6] * 50
    rows = [("close", v) for v in close] + [("equal", -3.5)] * 400 + [("signs", float(v)) for v in range(-60, 61)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    found = {r.k: r for r in distribution.distribution(df, ["k"], "v", max_groups=3).collect()}
    for name, q in distribution.QUARTILES.items():
        for key in ("close", "equal", "signs"):
            assert found[key][name] == quantile([v for k, v in rows if k == key], q), (key, name)
    assert len(seen) == 2 if sub_bins == 1 << 16 else 3 < len(seen) < 60


def test_neighbouring_doubles_are_told_apart(spark):
    values = [1.0]
    for _ in range(8):
        values.append(math.nextafter(values[-1], 2))
    row = distribution.distribution(spark.createDataFrame([(v,) for v in values], "v double"), [], "v").first()
    assert (row.p25, row.p50, row.p75) == (values[2], values[4], values[6])


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (3.0, 30.0), (4.0, 40.0)], "a double, b double")
    out = {r.statistic: (r.a, r.b) for r in distribution.describe(df, ["a", "b"]).collect()}
    assert list(out) == distribution.SUMMARY_COLUMNS
    assert out["n"] == (4, 3) and out["p25"] == (1.75, 20.0) and out["max"] == (4, 40)


def test_first_per_key_limits_groups_before_the_shuffle(skewed):
    rows, df = skewed
    first = groups.first_per_key(df, ["k"], ["i"])
    expected = {}
    for k, _, i in sorted(rows, key=lambda r: r[2]):
        expected.setdefault(k, i)
    assert {r.k: r.i for r in first.collect()} == expected
    assert planned(first).count("WindowGroupLimit") == 2


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, i int")
    assert tuple(groups.duplicate_count(df, ["k"]).first()) == (5, 3, 2)
    assert sorted(r.i for r in groups.duplicate_members(df, ["k"]).collect()) == [1, 2, 4, 5]
    assert tuple(groups.duplicate_count(df.limit(0), ["k"]).first()) == (0, 0, 0)


def test_large_groups_drop_null_keys(spark):
    df = spark.createDataFrame([("a", "x")] * 4 + [("a", None)] * 5 + [(None, "x")] * 5 + [("b", "x")] * 3, "s string, t string")
    kept = groups.rows_of_large_groups(df, ["s", "t"], "t", 3)
    assert [tuple(r) for r in kept.collect()] == [("a", "x")] * 4
    bounded = groups.rows_of_large_groups(df, ["s", "t"], "t", 3, max_groups=6)
    assert bounded.count() == 4 and "BroadcastHashJoin" in planned(bounded)


def test_top_values_and_ties(spark):
    df = spark.createDataFrame([(v,) for v in "ccbbaad"] + [(None,)] * 9, "v string")
    assert [r.v for r in counts.top_values(df, "v", 2).collect()] == ["a", "b"]
    rows = counts.rows_with_top_values(df, "v", 2)
    assert sorted(r.v for r in rows.collect()) == ["a", "a", "b", "b"]
    assert "LeftSemi" in planned(rows)
    plan = planned(counts.top_values(df, "v", 2))
    assert "TakeOrderedAndProject" in plan


def test_shares_sum_to_one(skewed):
    _, df = skewed
    assert sum(r.share for r in counts.share(df, "k").collect()) == pytest.approx(1)
    assert counts.share(df, "k").where("k is null").first().n == 1
    top = counts.top_share(df, "k", 5).collect()
    assert len(top) == 5 and sum(r.share for r in top) == pytest.approx(1)


def test_list_counts_ignore_order(spark):
    df = spark.createDataFrame([(["b", "a"],), (["a", "b"],), (["a"],), (None,)], "l array<string>")
    assert {tuple(r.l): r.n for r in counts.list_counts(df, "l").collect()} == {("a", "b"): 2, ("a",): 1}


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, `b.c` string")
    assert {r.column_name: r.n_null for r in counts.null_counts(df).collect()} == {"a": 1, "b.c": 2}


def test_flow_counts_over_the_whole_table(spark):
    pairs = [("c1", "t1")] * 5 + [("c1", "c1")] * 4 + [("c2", "t1")] * 4 + [(None, "t3")] * 20 + [("c3", "t2")] * 2 + [("c2", None)] * 9
    df = spark.createDataFrame(pairs, "c string, t string")
    edges = flow.flow_edges(df, "c", "t", 2, 3, 4)
    # t3 is frequent although none of its rows has a category.
    assert sorted(tuple(r) for r in edges.collect()) == [("c1", "c1", 4), ("c1", "t1", 5), ("c2", "t1", 4)]
    nodes = flow.flow_nodes(edges)
    assert sorted((r.node_id, r.label) for r in nodes.collect()) == [(0, "c1"), (1, "c2"), (2, "t1")]
    coded = flow.encode_edges(edges, nodes, 5).collect()
    assert sorted((r.source_id, r.target_id, r.n) for r in coded) == [(0, 0, 4), (0, 2, 5), (1, 2, 4)]


def test_flow_scans_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("string(id % 5) c", "string(id % 7) t").write.parquet(path)
    edges = flow.flow_edges(spark.read.parquet(path), "c", "t", 3, 3, 1)
    coded = flow.encode_edges(edges, flow.flow_nodes(edges), 6)
    final = executed(coded)
    assert final.count("FileScan") == 1
    numbered = flow.numbered_edges(edges)
    plan = planned(numbered)
    assert plan.count("FileScan") == 1 and "Join" not in plan and "WindowGroupLimit" in plan
    assert sorted(map(tuple, numbered.select(*coded.columns).collect())) == sorted(map(tuple, coded.collect()))


def test_edges_of_counted_pairs(spark):
    rng = random.Random(2)
    pairs = [(rng.choice(["a", "b", "c", "d", None]), rng.choice(["x", "y", "a", "b", None]), rng.randrange(1, 9)) for _ in range(80)]
    df = spark.createDataFrame(pairs, "source string, target string, n int")
    count, left, right = {}, {}, {}
    for s, t, n in pairs:
        count[s, t], left[s], right[t] = count.get((s, t), 0) + n, left.get(s, 0) + n, right.get(t, 0) + n

    def top(totals, n):
        return sorted((v for v in totals if v is not None), key=lambda v: (-totals[v], v))[:n]

    expected = {(s, t, n) for (s, t), n in count.items() if s in top(left, 3) and t in top(right, 2) and n >= 5}
    assert {tuple(r) for r in flow.edges_of_pairs(df, 3, 2, 5).collect()} == expected


def test_sort_by_seniority(spark):
    levels = ["Senior", None, "Guru", "Trainee", "Expert", "Mid", "Junior"]
    df = spark.createDataFrame([(v,) for v in levels], "seniority string").repartition(3)
    assert [r.seniority for r in ordering.sort_by_seniority(df).collect()][:5] == ["Trainee", "Junior", "Mid", "Senior", "Expert"]


def test_filters(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (39999.0,), (40000.0,), (None,)], "v double")
    assert filters.keep_between(df, F.col("v"), above=0, below=40000).count() == 2
    assert filters.keep_between(df, F.col("v"), below=40000).count() == 3
    assert [r.v for r in filters.head(df, 2, F.col("v").desc_nulls_last()).collect()] == [40000.0, 39999.0]
    with pytest.raises(ValueError):
        filters.head(df, 2)


def test_explode_keeps_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, l array<string>")
    assert sorted((r.i, str(r.l)) for r in filters.explode_list(df, "l").collect()) == [(1, "a"), (1, "b"), (2, "None"), (3, "None")]
    assert filters.explode_list(df, "l", keep_empty=False).count() == 2


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', named_struct('b', 2), 'c', array(3)) AS s")
    flat = flatten.flatten_structs(df)
    assert flat.columns == ["id", "s.a.b", "s.c"] and tuple(flat.first()) == (1, 2, [3])


def test_duplicate_members_send_each_row_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("if(id % 7 = 0, null, id % 60) k", "id v").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = groups.duplicate_members(spark.read.parquet(path), ["k"])
        plan = planned(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows once, their keys' counts once, and of these the repeated ones for the join.
    assert plan.count("Exchange hashpartitioning") == 3
    counts_ = plan[plan.index("Filter (_n") :]
    assert counts_.count("Exchange hashpartitioning") == 1 and "partial_count" in counts_
    keys = [None if i % 7 == 0 else i % 60 for i in range(100)]
    assert sorted(r.v for r in found.collect()) == [i for i in range(100) if keys.count(keys[i]) > 1]
