"""Projections and row filters."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` a column that is absent is an error."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"columns to drop are absent: {absent}")
    return df.drop(*names)


def keep_equal(df: DataFrame, value: Column, wanted) -> DataFrame:
    """Rows where ``value`` equals ``wanted``; NULL is dropped."""
    return df.where(value == wanted)


def keep_members(df: DataFrame, value: Column, wanted: Iterable) -> DataFrame:
    return df.where(value.isin(list(wanted)))


def keep_between(df: DataFrame, value: Column, above=None, below=None) -> DataFrame:
    """Rows strictly inside the given bounds; a bound of None is open."""
    if above is not None:
        df = df.where(value > above)
    if below is not None:
        df = df.where(value < below)
    return df


def explode_list(df: DataFrame, name: str, keep_empty: bool = True) -> DataFrame:
    """One row per element of an array column, under the same name.

    With ``keep_empty`` a row with an empty or NULL list stays once, with NULL.
    """
    unfold = F.explode_outer if keep_empty else F.explode
    return df.withColumn(name, unfold(name))


def head(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows of a stated order."""
    if not order:
        raise ValueError("state an order: rows of a DataFrame have none")
    return df.orderBy(*order).limit(k)
