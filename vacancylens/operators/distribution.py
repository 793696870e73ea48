"""Exact distribution summaries without gathering or sorting a group's values.

Quartiles need ranks. Values are counted per narrow, order-preserving bin; running
totals over the bins of a group tell which bins hold the wanted ranks. These bins
are split again, between their own least and greatest value, and counted in the
same way, until least and greatest are equal: then the rank's value is known. All
passes combine before their shuffle. A task orders the parts of a bin, of which
there are at most ``SUB_BINS``, whatever values the data hold; two passes do for
most data and five for any.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.functions.numbers import magnitude_bin
from vacancylens.operators.bounded import broadcast_bounded
from vacancylens.session import new_folder

#: Parts that a bin with a wanted rank is split into.
SUB_BINS = 1 << 16
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SUMMARY_COLUMNS = ["n", "mean", "stddev", "min", "p25", "p50", "p75", "max"]


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float] = QUARTILES,
    more_than: int = 0,
    max_groups: int | None = None,
) -> DataFrame:
    """Per group: n, mean, stddev, min, interpolated quantiles, max of ``value``.

    Groups with ``more_than`` or fewer values are left out. ``max_groups`` is a
    bound the caller can prove for the number of groups; with it the selected
    bins (two per quantile and group) are broadcast to the next pass. The passes run
    at once; their small results are intermediate tables.
    """
    keys = list(keys)
    if not keys:  # the whole table is one group
        whole = df.withColumn("_all", F.lit(1))
        return distribution(whole, ["_all"], value, quantiles, more_than, max_groups=1).drop("_all")
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_v"), magnitude_bin(number).alias("_bin")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    return summary(bin_counts(rows, keys), rows, keys, quantiles, F.lit(more_than), max_groups)


def bin_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First pass: per group and bin the number, mean, variance and range of its values."""
    return rows.groupBy(*keys, "_bin").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("_v").alias("_bin_mean"),
        F.var_pop("_v").alias("_bin_var"),
        F.min("_v").alias("_bin_min"),
        F.max("_v").alias("_bin_max"),
    )


def summary(
    bins: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    quantiles: dict[str, float] = QUARTILES,
    more_than: Column | int = 0,
    max_groups: int | None = None,
    order: Sequence[str] = ("_bin",),
) -> DataFrame:
    """:func:`distribution` from counted bins, as :func:`bin_counts` gives them.

    ``rows`` are the values behind them, ``(*keys, _v, _bin)``. Bins may be finer
    than ``_bin``; ``order`` then names the columns whose order is that of the values.
    ``more_than`` may depend on the keys.
    """
    keys = list(keys)

    # 0-based ranks around each quantile, and how far it lies between the two.
    ranks = {}
    for name, q in quantiles.items():
        place = F.lit(q) * (F.col("_total") - 1)
        ranks[name] = (F.floor(place), F.ceil(place), place - F.floor(place))

    holds_a_rank = F.lit(False)
    for below, above, _ in ranks.values():
        for rank in (below, above):
            holds_a_rank |= (rank >= F.col("_start")) & (rank < F.col("_end"))
    wanted = _ranked_bins(bins, keys, order).where((F.col("_total") > more_than) & holds_a_rank)
    most = None if max_groups is None else 2 * len(quantiles) * max_groups
    placed = _values_with_ranks(rows, wanted, keys, holds_a_rank, most)

    def value_at(rank):
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_low")))

    found = {"n": F.max("_total")} | {name: F.max(f"_{name}") for name in ("mean", "stddev", "min")}
    for name, (below, above, part) in ranks.items():
        low, high = value_at(below), value_at(above)
        found[name] = F.when(low == high, low).otherwise(low + (high - low) * F.max(part))
    found["max"] = F.max("_max")
    return placed.groupBy(*keys).agg(*[column.alias(name) for name, column in found.items()])


def _ranked_bins(per_bin: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    """Per group and bin the ranks it covers, with the group's totals.

    The totals ride on the bin rows, so the bins are needed in one place only
    and the first pass runs once.
    """
    group = Window.partitionBy(*keys)
    # Pooled variance: spread inside the bins plus spread of the bin means.
    spread = F.col("_n") * (F.col("_bin_var") + F.pow(F.col("_bin_mean") - F.col("_mean"), 2))
    return (
        per_bin.withColumn("_end", F.sum("_n").over(group.orderBy(*order)))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(group))
        .withColumn("_mean", F.sum(F.col("_n") * F.col("_bin_mean")).over(group) / F.col("_total"))
        .withColumn("_stddev", F.sqrt(F.sum(spread).over(group) / F.nullif(F.col("_total") - 1, F.lit(0))))
        .withColumn("_min", F.min("_bin_min").over(group))
        .withColumn("_max", F.max("_bin_max").over(group))
        .withColumnsRenamed({"_bin_min": "_low", "_bin_max": "_high"})
        .drop("_bin_mean", "_bin_var", "_n")
    )


_TOTALS = ["_total", "_mean", "_stddev", "_min", "_max"]


def _values_with_ranks(rows: DataFrame, wanted: DataFrame, keys: list[str], holds_a_rank: Column, most: int | None) -> DataFrame:
    """The values ``_low`` that cover the wanted ranks, with the ranks they cover.

    Each round reads the rows of the bins that are still open and stores their
    parts with a rank, a few rows for each group.
    """
    spark, found = rows.sparkSession, None
    while True:
        path = new_folder(spark, "ranks")
        parts = _parts(rows, broadcast_bounded(wanted, most), keys).where(holds_a_rank)
        parts.write.parquet(path)
        stored = spark.read.schema(parts.schema).parquet(path)
        known = stored.where("_low = _high")
        found = known if found is None else found.unionByName(known)
        wanted = stored.where("_low < _high")
        if wanted.isEmpty():
            return found


def _parts(rows: DataFrame, bins: DataFrame, keys: list[str]) -> DataFrame:
    """The bins split evenly between their least and greatest value, with ranks like theirs."""
    cut = bins.select(*[F.col(c).alias(f"_w{c}") for c in [*keys, "_bin"]], "_start", "_low", "_high", *_TOTALS)
    same = [F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in [*keys, "_bin"]]
    inside = rows.join(cut, [*same, F.col("_v") >= F.col("_low"), F.col("_v") <= F.col("_high")])
    share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    place = F.when(F.col("_low") == F.col("_high"), F.lit(0)).otherwise(F.floor(share * SUB_BINS).cast("int"))
    own = [*keys, "_bin", F.col("_low").alias("_of")]
    counted = inside.groupBy(*own, place.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), *[F.max(t).alias(t) for t in ["_start", *_TOTALS]]
    )
    before = Window.partitionBy(*keys, "_bin", "_of").orderBy("_part")
    placed = counted.withColumn("_end", F.col("_start") + F.sum("_n").over(before))
    return placed.select(
        *keys, "_bin", (F.col("_end") - F.col("_n")).alias("_start"), "_end", F.col("_least").alias("_low"), F.col("_most").alias("_high"), *_TOTALS
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per statistic and one column per described column."""
    melted = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns])
        )
    )
    summary = distribution(melted, ["_column"], "_value", max_groups=len(columns))
    cells = summary.select(
        "_column",
        F.posexplode(
            F.array(
                *[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("v")) for s in SUMMARY_COLUMNS]
            )
        ).alias("_order", "_cell"),
    )
    return (
        cells.groupBy("_order", F.col("_cell.statistic").alias("statistic"))
        .agg(*[F.max(F.when(F.col("_column") == c, F.col("_cell.v"))).alias(c) for c in columns])
        .orderBy("_order")
        .drop("_order")
    )
