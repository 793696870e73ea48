"""Deduplication and group-size filters that stay safe on hot keys."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.operators.bounded import broadcast_bounded


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every key; NULL keys form one group.

    The ``row_number() = 1`` filter becomes a group limit before the shuffle:
    each task sends at most one row per key, so a hot key costs one row per
    task and never a whole group.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key, with rows and keys counted."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        )
    )


def rows_of_groups(
    df: DataFrame,
    keys: Sequence[str],
    having: Column,
    max_groups: int | None = None,
    null_groups: bool = True,
    **aggregates: Column,
) -> DataFrame:
    """All rows of the groups whose aggregates satisfy ``having``.

    Groups are counted with map-side combining and joined back, instead of
    gathering every group's rows in one window partition. The join is
    null-safe, so a NULL key counts as a value; AQE splits a hot key. Without
    ``null_groups`` no key is NULL, and the plain equality lets the join reuse the
    partitioning of the counts. With a proven ``max_groups`` the groups are broadcast and the rows stay in place.
    """
    chosen = (
        df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(*[value.alias(name) for name, value in aggregates.items()])
        .where(having)
        .select(*[f"_{k}" for k in keys])
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) if null_groups else F.col(k) == F.col(f"_{k}") for k in keys]
    return df.join(broadcast_bounded(chosen, max_groups), same, "left_semi")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    return rows_of_groups(df, keys, F.col("_n") > 1, _n=F.count(F.lit(1)))


def rows_of_large_groups(
    df: DataFrame, keys: Sequence[str], counted: str, more_than: int, max_groups: int | None = None
) -> DataFrame:
    """Rows of groups with more than ``more_than`` non-null ``counted`` cells.

    Rows with a NULL in any key belong to no group and vanish.
    """
    grouped = df.dropna(subset=list(keys))
    return rows_of_groups(grouped, keys, F.col("_n") > more_than, max_groups, null_groups=False, _n=F.count(counted))
