"""Value counts, most frequent values and shares."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens.operators.bounded import broadcast_bounded


def value_counts(df: DataFrame, *names: str) -> DataFrame:
    """Rows per value (or combination of values) as ``n``; NULL is not a value."""
    return df.dropna(subset=list(names)).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def list_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per whole list; lists with the same members in any order match."""
    return value_counts(df.select(F.array_sort(name).alias(name)), name)


def most_frequent(counts: DataFrame, n: int, by: str = "n") -> DataFrame:
    """The ``n`` largest of a counts table; ties go to the smaller value.

    ``orderBy().limit()`` runs as a per-task top-n followed by a merge of those,
    not as a global sort.
    """
    ties = [F.col(c).asc() for c in counts.columns if c != by]
    return counts.orderBy(F.col(by).desc(), *ties).limit(n)


def top_values(df: DataFrame, name: str, n: int) -> DataFrame:
    return most_frequent(value_counts(df, name), n).select(name)


def rows_with_top_values(df: DataFrame, name: str, n: int) -> DataFrame:
    """Rows that hold one of the ``n`` most frequent values of a column."""
    return df.join(broadcast_bounded(top_values(df, name, n), n), name, "left_semi")


def with_share(counts: DataFrame) -> DataFrame:
    """Add ``share``, each row's part of the sum of ``n``.

    The total is a scalar subquery, so no task has to hold all rows.
    """
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def share(df: DataFrame, name: str) -> DataFrame:
    """Count and share of every value, NULL included as a slice of its own."""
    return with_share(df.groupBy(name).agg(F.count(F.lit(1)).alias("n")))


def top_share(df: DataFrame, name: str, n: int) -> DataFrame:
    """Count and share among the rows holding the ``n`` most frequent values.

    The counts that rank the values are the counts to show, so the rows are
    read once and never joined back.
    """
    return with_share(most_frequent(value_counts(df, name), n))


def null_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column_name, n_null)``, all columns counted in one pass."""
    names = list(names or df.columns)
    cells = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_null")) for i, c in enumerate(names)]
    return cells.select(F.inline(F.array(*pairs)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def histogram(df: DataFrame, by: Sequence[str], bin_column: Column) -> DataFrame:
    """Rows per group and bin as ``n``."""
    return df.groupBy(*by, bin_column.alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))
