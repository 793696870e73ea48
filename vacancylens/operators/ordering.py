"""Orders given by a list instead of by the values themselves."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens.fixed_values import SENIORITY_ORDER


def rank_of(value: Column, order: dict[str, int]) -> Column:
    """Rank of a value; NULL for a value the order does not know."""
    return F.create_map(*[F.lit(part) for pair in order.items() for part in pair])[value]


def sort_by_seniority(df: DataFrame, *then: Column | str, name: str = "seniority") -> DataFrame:
    """Least to most experienced; unknown levels and NULL come last.

    Columns in ``then`` order rows of one level, and let a frequent level
    spread over several sort tasks.
    """
    return df.orderBy(rank_of(F.col(name), SENIORITY_ORDER).asc_nulls_last(), F.col(name), *then)
