"""Exploratory profile of extracted postings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.operators import counts
from vacancylens.operators.distribution import describe
from vacancylens.operators.groups import duplicate_count, duplicate_members

SALARY_COLUMNS = ["salary_min", "salary_max", "salary_mean"]


def salary_describe(documents: DataFrame, min_above: float = 0) -> DataFrame:
    """Describe the salaries of postings that state a real range."""
    real = documents.where((F.col("salary_min") > min_above) & (F.col("salary_max") > F.col("salary_min")))
    return describe(real, SALARY_COLUMNS)


def frequent_values(df: DataFrame, name: str, k: int = 30) -> DataFrame:
    return counts.most_frequent(counts.value_counts(df, name), k)


def data_profile(postings: DataFrame, k: int = 30) -> dict[str, DataFrame]:
    """The tables of a first look at a snapshot."""
    return {
        "rows": counts.row_count(postings),
        "nulls": counts.null_counts(postings),
        "duplicates": duplicate_count(postings, ["id"]),
        "duplicate_members": duplicate_members(postings, ["id"]),
        "technologies": frequent_values(postings, "technology", k),
        "categories": counts.value_counts(postings, "category"),
        "seniorities": counts.list_counts(postings, "seniority"),
    }
