"""All stored insights from one small table of cells.

One pass over the documents counts cells: pairs of category and technology, levels
and contracts of a technology with salaries in narrow bins, places by level. Shares,
flow, histograms, outlines, city tables and the first pass of the distributions are
sums of cells. Only the distributions look at the documents again, all of them in
the same second pass, for the bins that hold a wanted rank.

The results are those of the queries in :mod:`vacancylens.plans.insights`, which
read documents and suit a single question. Salaries are binned by ``WIDTH``, so
limits have to be its multiples.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.functions.numbers import bin_start, magnitude_bin
from vacancylens.functions.text import yes_no
from vacancylens.operators import counts, flow
from vacancylens.operators.bounded import broadcast_bounded
from vacancylens.operators.distribution import summary
from vacancylens.operators.filters import keep_members
from vacancylens.operators.ordering import sort_by_seniority

WIDTH = 1000
#: What a cell counts: pairs of category and technology, documents by remote, technologies
#: by level and by contract type, cities by level (or of all levels).
PAIR, REMOTE, LEVEL, CONTRACT, CITY = "pair", "remote", "level", "contract", "city"


def _cell(kind: str, a: Column, b: Column | None = None, salary: Column | None = None, place: Column | None = None) -> Column:
    number = F.lit(None).cast("double")
    lat, lon = (number, number) if place is None else (place["lat"], place["lon"])
    return F.struct(
        F.lit(kind).alias("kind"),
        a.cast("string").alias("a"),
        (F.lit(None) if b is None else b).cast("string").alias("b"),
        (number if salary is None else salary).alias("v"),
        lat.alias("lat"),
        lon.alias("lon"),
    )


def _levels() -> Column:
    """A document's levels; one NULL if it has none."""
    return F.when(F.size("seniority") > 0, F.col("seniority")).otherwise(F.array(F.lit(None).cast("string")))


def _salary() -> Column:
    return F.when(~F.isnan("salary_mean"), F.col("salary_mean"))


def insight_cube(documents: DataFrame) -> DataFrame:
    """``kind, a, b, bin, width`` with counts and moments of the cells; one scan, one exchange."""
    known = F.filter(F.coalesce("city", F.array()), lambda c: c["city"].isNotNull())
    given = F.filter(F.coalesce("seniority", F.array()), lambda s: s.isNotNull())
    technology, salary = F.col("technology"), F.col("salary_mean")
    cells = F.concat(
        F.array(_cell(PAIR, F.col("category"), technology), _cell(REMOTE, yes_no(F.col("remote")))),
        F.transform(_levels(), lambda s: _cell(LEVEL, technology, s, _salary())),
        F.array(_cell(CONTRACT, technology, F.col("contract_type"), _salary())),
        F.transform(known, lambda c: _cell(CITY, c["city"], None, salary, c)),
        F.flatten(F.transform(known, lambda c: F.transform(given, lambda s: _cell(CITY, c["city"], s, salary, c)))),
    )
    rows = documents.select(F.col("id").isNotNull().alias("has_id"), F.inline(cells))
    binned = F.col("kind").isin(LEVEL, CONTRACT) & F.col("v").isNotNull()
    bins = [F.when(binned, magnitude_bin(F.col("v"))).alias("bin"), F.when(binned, bin_start(F.col("v"), WIDTH)).alias("width")]
    return rows.groupBy("kind", "a", "b", *bins).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("has_id").alias("n_ids"),
        F.avg("v").alias("mean"),
        F.var_pop("v").alias("var"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
    )


def _of(cube: DataFrame, *kinds: str) -> DataFrame:
    return cube.where(F.col("kind").isin(*kinds))


def _summed(cells: DataFrame, *by: Column) -> DataFrame:
    return cells.groupBy(*by).agg(F.sum("n").alias("n"))


# ---- shares and flow --------------------------------------------------------


def technology_share(cube: DataFrame, n: int = fixed.SHARE_TOP_N) -> DataFrame:
    named = _of(cube, PAIR).where("b is not null")
    return counts.with_share(counts.most_frequent(_summed(named, F.col("b").alias("technology")), n))


def category_share(cube: DataFrame, n: int = fixed.SHARE_TOP_N) -> DataFrame:
    named = _of(cube, PAIR).where("a is not null")
    return counts.with_share(counts.most_frequent(_summed(named, F.col("a").alias("category")), n))


def seniority_share(cube: DataFrame) -> DataFrame:
    return counts.with_share(_summed(_of(cube, LEVEL), F.col("b").alias("seniority")))


def remote_share(cube: DataFrame) -> DataFrame:
    return counts.with_share(_summed(_of(cube, REMOTE), F.col("a").alias("remote")))


def _edges(cube: DataFrame, n_categories: int, n_technologies: int, min_flow: int) -> DataFrame:
    pairs = _of(cube, PAIR).select(F.col("a").alias("source"), F.col("b").alias("target"), "n")
    return flow.edges_of_pairs(pairs, n_categories, n_technologies, min_flow)


def category_technology_flow(
    cube: DataFrame, n_categories: int = fixed.FLOW_TOP_N, n_technologies: int = fixed.FLOW_TOP_N, min_flow: int = fixed.FLOW_MIN_COUNT
) -> DataFrame:
    edges = flow.numbered_edges(_edges(cube, n_categories, n_technologies, min_flow))
    return edges.select(F.col("source").alias("category"), F.col("target").alias("technology"), "source_id", "target_id", "n")


def category_technology_nodes(
    cube: DataFrame, n_categories: int = fixed.FLOW_TOP_N, n_technologies: int = fixed.FLOW_TOP_N, min_flow: int = fixed.FLOW_MIN_COUNT
) -> DataFrame:
    return flow.flow_nodes(_edges(cube, n_categories, n_technologies, min_flow))


# ---- places, histogram and outlines -----------------------------------------


def salary_by_city(cube: DataFrame, n: int = fixed.CITY_TOP_N, seniority: str | None = None) -> DataFrame:
    level = F.col("b").isNull() if seniority is None else F.col("b") == seniority
    cities = _of(cube, CITY).where(level)
    named = cities.select(F.col("a").alias("city"), F.col("n_ids").alias("job_counts"), F.col("mean").alias("salary_mean"), "lat", "lon", "n")
    return named.orderBy(F.desc("n"), "city").limit(n).drop("n")


def _with_level(seniority: str) -> Callable[..., DataFrame]:
    return lambda cube, n=fixed.CITY_TOP_N: salary_by_city(cube, n, seniority)


def salary_histogram(cube: DataFrame, limit: float = fixed.HISTOGRAM_SALARY_LIMIT) -> DataFrame:
    paid = _of(cube, LEVEL).where((F.col("bin") > 0) & (F.col("width") < limit) & F.col("b").isNotNull())
    return sort_by_seniority(_summed(paid, F.col("b").alias("seniority"), F.col("width").alias("bin_start")), "bin_start")


def _top_technologies(cube: DataFrame, kind: str, n: int) -> DataFrame:
    """Ranked on postings (``PAIR``) or on postings and levels (``LEVEL``)."""
    technology = F.col("a" if kind == LEVEL else "b")
    ranked = _summed(_of(cube, kind).where(technology.isNotNull()), technology.alias("a"))
    return broadcast_bounded(counts.most_frequent(ranked, n).select("a"), n)


def _level_cells(cube: DataFrame, n: int, limit: float) -> DataFrame:
    paid = _of(cube, LEVEL).where(F.col("width") < limit)
    chosen = keep_members(paid, F.col("b"), fixed.DISTRIBUTION_SENIORITIES)
    return chosen.join(_top_technologies(cube, LEVEL, n), "a", "left_semi")


def _contract_cells(cube: DataFrame, n: int, limit: float, contracts: Sequence[str]) -> DataFrame:
    paid = _of(cube, CONTRACT).where(F.col("width") < limit)
    chosen = keep_members(paid, F.col("b"), contracts)
    return chosen.join(_top_technologies(cube, PAIR, n), "a", "left_semi")


def technology_salary_shape(cube: DataFrame, n: int = fixed.DISTRIBUTION_TOP_N, limit: float = fixed.TECHNOLOGY_SALARY_LIMIT) -> DataFrame:
    cells = _level_cells(cube, n, limit)
    return _summed(cells, F.col("b").alias("seniority"), F.col("a").alias("technology"), F.col("width").alias("bin_start"))


def contract_salary_shape(
    cube: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    limit: float = fixed.CONTRACT_SALARY_LIMIT,
    contracts: Sequence[str] = tuple(fixed.DISTRIBUTION_CONTRACTS),
) -> DataFrame:
    cells = _contract_cells(cube, n, limit, contracts)
    return _summed(cells, F.col("b").alias("contract_type"), F.col("a").alias("technology"), F.col("width").alias("bin_start"))


# ---- distributions ----------------------------------------------------------


def salary_distributions(
    cube: DataFrame,
    documents: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    more_than: int = fixed.DISTRIBUTION_MIN_GROUP,
    contracts: Sequence[str] = tuple(fixed.DISTRIBUTION_CONTRACTS),
) -> DataFrame:
    """``kind, b, a`` and the summary of both distributions' groups, in one pass over the documents."""
    cells = _level_cells(cube, n, fixed.TECHNOLOGY_SALARY_LIMIT).unionByName(_contract_cells(cube, n, fixed.CONTRACT_SALARY_LIMIT, contracts))
    renamed = {"bin": "_bin", "width": "_width", "n": "_n", "mean": "_bin_mean", "var": "_bin_var", "min": "_bin_min", "max": "_bin_max"}
    bins = cells.select("kind", "b", "a", *[F.col(c).alias(name) for c, name in renamed.items()])
    groups = F.concat(
        F.transform(_levels(), lambda s: F.struct(F.lit(LEVEL).alias("kind"), s.alias("b"))),
        F.array(F.struct(F.lit(CONTRACT).alias("kind"), F.col("contract_type").alias("b"))),
    )
    paid = documents.select(F.col("technology").alias("a"), _salary().alias("_v"), groups.alias("groups")).where("_v is not null and a is not null")
    rows = paid.select("a", "_v", magnitude_bin(F.col("_v")).alias("_bin"), F.inline("groups"))
    limit = F.when(F.col("kind") == LEVEL, fixed.TECHNOLOGY_SALARY_LIMIT).otherwise(fixed.CONTRACT_SALARY_LIMIT)
    least = F.when(F.col("kind") == LEVEL, more_than).otherwise(0)
    most = n * (len(fixed.DISTRIBUTION_SENIORITIES) + len(contracts))
    return summary(bins, rows.where(F.col("_v") < limit), ["kind", "b", "a"], more_than=least, max_groups=most, order=("_bin", "_width"))


def _distribution(distributions: DataFrame, kind: str, by: str) -> DataFrame:
    named = _of(distributions, kind).withColumnsRenamed({"b": by, "a": "technology"}).drop("kind")
    return named.select(by, "technology", *[c for c in named.columns if c not in (by, "technology")])


#: Insights that are sums of cells, by the names they are stored under.
FROM_CELLS: dict[str, Callable[..., DataFrame]] = {
    "technology_share": technology_share,
    "category_share": category_share,
    "seniority_share": seniority_share,
    "remote_share": remote_share,
    "category_technology_flow": category_technology_flow,
    "category_technology_nodes": category_technology_nodes,
    "salary_by_city": salary_by_city,
    "salary_by_city_junior": _with_level("Junior"),
    "salary_by_city_mid": _with_level("Mid"),
    "salary_by_city_senior": _with_level("Senior"),
    "salary_histogram": salary_histogram,
    "technology_salary_shape": technology_salary_shape,
    "contract_salary_shape": contract_salary_shape,
}


def insights_of_cube(cube: DataFrame, documents: DataFrame) -> dict[str, DataFrame]:
    """Every stored insight by its name; ``documents`` are read for the distributions only."""
    distributions = salary_distributions(cube, documents)
    return {name: build(cube) for name, build in FROM_CELLS.items()} | {
        "technology_salary_distribution": _distribution(distributions, LEVEL, "seniority"),
        "contract_salary_distribution": _distribution(distributions, CONTRACT, "contract_type"),
    }
