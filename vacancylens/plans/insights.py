"""Named insight queries over cleaned postings.

Each takes the document table and returns a small aggregate. They are lazy, so
a caller that runs several may persist the document table first.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.functions.numbers import bin_start
from vacancylens.functions.text import yes_no
from vacancylens.functions.times import display_date
from vacancylens.operators import counts, flow
from vacancylens.operators.bounded import broadcast_bounded
from vacancylens.operators.distribution import distribution
from vacancylens.operators.filters import explode_list, keep_between, keep_members
from vacancylens.operators.ordering import sort_by_seniority
from vacancylens.plans.tables import exploded_cities

Insight = Callable[..., DataFrame]
INSIGHTS: dict[str, Insight] = {}


def insight(name: str) -> Callable[[Insight], Insight]:
    """Register a query under a name."""

    def register(query: Insight) -> Insight:
        if name in INSIGHTS:
            raise ValueError(f"insight {name} is registered twice")
        INSIGHTS[name] = query
        return query

    return register


def all_insights(documents: DataFrame) -> dict[str, DataFrame]:
    return {name: query(documents) for name, query in INSIGHTS.items()}


# ---- shares -----------------------------------------------------------------


@insight("technology_share")
def technology_share(documents: DataFrame, n: int = fixed.SHARE_TOP_N) -> DataFrame:
    return counts.top_share(documents, "technology", n)


@insight("category_share")
def category_share(documents: DataFrame, n: int = fixed.SHARE_TOP_N) -> DataFrame:
    return counts.top_share(documents, "category", n)


@insight("seniority_share")
def seniority_share(documents: DataFrame) -> DataFrame:
    return counts.share(explode_list(documents.select("seniority"), "seniority"), "seniority")


@insight("remote_share")
def remote_share(documents: DataFrame) -> DataFrame:
    return counts.share(documents.select(yes_no(F.col("remote")).alias("remote")), "remote")


# ---- flow -------------------------------------------------------------------


def category_technology_edges(
    documents: DataFrame,
    n_categories: int = fixed.FLOW_TOP_N,
    n_technologies: int = fixed.FLOW_TOP_N,
    min_flow: int = fixed.FLOW_MIN_COUNT,
) -> DataFrame:
    return flow.flow_edges(documents, "category", "technology", n_categories, n_technologies, min_flow)


@insight("category_technology_flow")
def category_technology_flow(
    documents: DataFrame,
    n_categories: int = fixed.FLOW_TOP_N,
    n_technologies: int = fixed.FLOW_TOP_N,
    min_flow: int = fixed.FLOW_MIN_COUNT,
) -> DataFrame:
    """Edges with the ids of their two nodes."""
    edges = category_technology_edges(documents, n_categories, n_technologies, min_flow)
    return flow.numbered_edges(edges).select(
        F.col("source").alias("category"), F.col("target").alias("technology"), "source_id", "target_id", "n"
    )


@insight("category_technology_nodes")
def category_technology_nodes(
    documents: DataFrame,
    n_categories: int = fixed.FLOW_TOP_N,
    n_technologies: int = fixed.FLOW_TOP_N,
    min_flow: int = fixed.FLOW_MIN_COUNT,
) -> DataFrame:
    return flow.flow_nodes(category_technology_edges(documents, n_categories, n_technologies, min_flow))


# ---- salaries by place ------------------------------------------------------


def _city_salaries(places: DataFrame) -> DataFrame:
    """Per known city: rows, jobs, mean salary and coordinates, in one aggregation."""
    return (
        places.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("id").alias("job_counts"),
            F.avg("salary_mean").alias("salary_mean"),
            F.avg("lat").alias("lat"),
            F.avg("lon").alias("lon"),
        )
    )


def _places(documents: DataFrame, seniority: str | None = None) -> DataFrame:
    if seniority is not None:
        # A level listed twice counts twice, so levels are exploded all the same.
        chosen = documents.where(F.array_contains("seniority", seniority))
        documents = explode_list(chosen, "seniority", keep_empty=False).where(F.col("seniority") == seniority)
    return exploded_cities(documents.select("id", "salary_mean", "city"))


@insight("salary_by_city")
def salary_by_city(documents: DataFrame, n: int = fixed.CITY_TOP_N, seniority: str | None = None) -> DataFrame:
    """The ``n`` cities with most jobs, ranked within the chosen seniority."""
    cities = _city_salaries(_places(documents, seniority))
    return cities.orderBy(F.col("_rows").desc(), "city").limit(n).drop("_rows")


@insight("salary_by_city_junior")
def salary_by_city_junior(documents: DataFrame, n: int = fixed.CITY_TOP_N) -> DataFrame:
    return salary_by_city(documents, n, "Junior")


@insight("salary_by_city_mid")
def salary_by_city_mid(documents: DataFrame, n: int = fixed.CITY_TOP_N) -> DataFrame:
    return salary_by_city(documents, n, "Mid")


@insight("salary_by_city_senior")
def salary_by_city_senior(documents: DataFrame, n: int = fixed.CITY_TOP_N) -> DataFrame:
    return salary_by_city(documents, n, "Senior")


def salary_by_city_min_jobs(
    documents: DataFrame, more_than: int = fixed.CITY_MIN_JOBS, seniority: str | None = None
) -> DataFrame:
    """All cities with more than ``more_than`` jobs."""
    cities = _city_salaries(_places(documents, seniority))
    return cities.where(F.col("job_counts") > more_than).drop("_rows")


# ---- salary distributions ---------------------------------------------------


@insight("salary_histogram")
def salary_histogram(
    documents: DataFrame, width: float = 1000, limit: float = fixed.HISTOGRAM_SALARY_LIMIT
) -> DataFrame:
    """Postings per seniority and salary bin, least to most experienced.

    A posting without levels belongs to no series and is not counted.
    """
    paid = keep_between(documents.select("seniority", "salary_mean"), F.col("salary_mean"), above=0, below=limit)
    levels = explode_list(paid, "seniority", keep_empty=False).where(F.col("seniority").isNotNull())
    bins = counts.histogram(levels, ["seniority"], bin_start(F.col("salary_mean"), width))
    return sort_by_seniority(bins, "bin_start")


def _technology_rows(
    documents: DataFrame, n: int, limit: float, seniorities: Sequence[str] = tuple(fixed.DISTRIBUTION_SENIORITIES)
) -> DataFrame:
    """Salaries of the top technologies, one row per posting and wanted level.

    Technologies are ranked on postings × levels, where a posting without
    levels counts once; that is a weighted count, so nothing is exploded for it.
    """
    weight = F.greatest(F.size("seniority"), F.lit(1))
    ranked = documents.where(F.col("technology").isNotNull()).groupBy("technology").agg(F.sum(weight).alias("n"))
    top = counts.most_frequent(ranked, n).select("technology")
    paid = keep_between(documents.select("technology", "seniority", "salary_mean"), F.col("salary_mean"), below=limit)
    levels = keep_members(explode_list(paid, "seniority", keep_empty=False), F.col("seniority"), seniorities)
    return levels.join(broadcast_bounded(top, n), "technology", "left_semi")


@insight("technology_salary_distribution")
def technology_salary_distribution(
    documents: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    limit: float = fixed.TECHNOLOGY_SALARY_LIMIT,
    more_than: int = fixed.DISTRIBUTION_MIN_GROUP,
) -> DataFrame:
    """Salary summary per seniority and technology, for groups large enough."""
    rows = _technology_rows(documents, n, limit)
    most = n * len(fixed.DISTRIBUTION_SENIORITIES)
    return distribution(rows, ["seniority", "technology"], "salary_mean", more_than=more_than, max_groups=most)


def _contract_rows(documents: DataFrame, n: int, limit: float, contracts: Sequence[str]) -> DataFrame:
    """Salaries of the top technologies, ranked on postings, per wanted contract."""
    paid = keep_between(
        documents.select("technology", "contract_type", "salary_mean"), F.col("salary_mean"), below=limit
    )
    chosen = keep_members(paid, F.col("contract_type"), contracts)
    top = counts.top_values(documents, "technology", n)
    return chosen.join(broadcast_bounded(top, n), "technology", "left_semi")


@insight("contract_salary_distribution")
def contract_salary_distribution(
    documents: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    limit: float = fixed.CONTRACT_SALARY_LIMIT,
    contracts: Sequence[str] = tuple(fixed.DISTRIBUTION_CONTRACTS),
) -> DataFrame:
    """Salary summary per contract type and technology."""
    rows = _contract_rows(documents, n, limit, contracts)
    return distribution(rows, ["contract_type", "technology"], "salary_mean", max_groups=n * len(contracts))


@insight("technology_salary_shape")
def technology_salary_shape(
    documents: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    limit: float = fixed.TECHNOLOGY_SALARY_LIMIT,
    width: float = 1000,
) -> DataFrame:
    """Binned outline of the technology distributions."""
    bins = bin_start(F.col("salary_mean"), width)
    return counts.histogram(_technology_rows(documents, n, limit), ["seniority", "technology"], bins)


@insight("contract_salary_shape")
def contract_salary_shape(
    documents: DataFrame,
    n: int = fixed.DISTRIBUTION_TOP_N,
    limit: float = fixed.CONTRACT_SALARY_LIMIT,
    width: float = 1000,
    contracts: Sequence[str] = tuple(fixed.DISTRIBUTION_CONTRACTS),
) -> DataFrame:
    """Binned outline of the contract distributions."""
    rows = _contract_rows(documents, n, limit, contracts)
    return counts.histogram(rows, ["contract_type", "technology"], bin_start(F.col("salary_mean"), width))


# ---- freshness --------------------------------------------------------------


def freshness(metadata: DataFrame) -> DataFrame:
    """The date a snapshot was obtained, as shown to readers."""
    return metadata.select("source_name", display_date(F.col("obtained_datetime")).alias("obtained"))
