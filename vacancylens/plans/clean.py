"""Cleaning: extracted postings to the document table.

Every step is a function from DataFrame to DataFrame; :func:`clean` chains them
in the order that is part of the result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.functions.numbers import row_mean
from vacancylens.functions.text import (
    capitalize,
    replace_values,
    split_before_capitals,
    title_case,
    unify_missing,
)
from vacancylens.operators.filters import drop_columns, keep_equal
from vacancylens.operators.groups import first_per_key
from vacancylens.operators.places import VALUE_PLACES, lookup_places, map_places, place_names


def drop_unwanted(df: DataFrame) -> DataFrame:
    return drop_columns(df, fixed.UNWANTED_COLUMNS)


def drop_duplicates(
    df: DataFrame, keys: Sequence[str] = ("id",), order: Sequence[Column | str] = ("pos",)
) -> DataFrame:
    return first_per_key(df, keys, order)


def extract_remote(df: DataFrame) -> DataFrame:
    return df.withColumn("remote", F.col("location.fullyRemote"))


def extract_place_names(df: DataFrame) -> DataFrame:
    return df.withColumn("place_names", place_names(F.col("location")))


def extract_locations(df: DataFrame, gazetteer: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Add ``city``, the canonical places of a posting in the order posted."""
    return lookup_places(extract_place_names(df), gazetteer, keys, countries=fixed.KEPT_COUNTRIES)


def extract_contract_type(df: DataFrame) -> DataFrame:
    return df.withColumn("contract_type", F.col("salary.type"))


def extract_salaries(df: DataFrame) -> DataFrame:
    low, high = F.col("salary").getField("from").cast("double"), F.col("salary").getField("to").cast("double")
    return df.withColumns({"salary_min": low, "salary_max": high, "salary_mean": row_mean(high, low)})


def keep_currency(df: DataFrame, currency: str = fixed.KEPT_CURRENCY) -> DataFrame:
    return keep_equal(df, F.col("salary.currency"), currency)


def lower_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in fixed.LOWER_COLUMNS})


def replace_names(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return replace_values(df, fixed.REPLACED_VALUES, subset)


def split_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: split_before_capitals(F.col(c)) for c in fixed.SPLIT_COLUMNS})


def title_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: title_case(F.col(c)) for c in fixed.TITLE_COLUMNS})


def capitalize_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: capitalize(F.col(c), fixed.SPECIAL_NAMES) for c in fixed.CAPITALIZED_COLUMNS})


def normalize_names(df: DataFrame) -> DataFrame:
    """The text steps in their order; missing values are unified last."""
    return (
        df.transform(lower_names)
        .transform(replace_names)
        .transform(split_names)
        .transform(title_names)
        .transform(capitalize_names)
        .transform(unify_missing)
    )


def clean(
    postings: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str] = ("id",),
    order: Sequence[Column | str] = ("pos",),
    max_places: int | None = None,
) -> DataFrame:
    """The document table: one row per posting, first occurrence of each id.

    Field extraction works on single rows, so it runs before the deduplication:
    the one shuffle then carries flat, narrow columns instead of the nested
    input. Duplicates go before the currency filter, because a repeated posting
    is represented by its first row whatever that row's currency. Both filters
    come before the place lookup, so no place is looked up for nothing. Keys in
    addition to ``id`` (a snapshot key) clean several snapshots at once.
    ``max_places`` is the size of a gazetteer known to be small; a very small one is
    looked up in place, without unfolding the lists.
    """
    extracted = (
        postings.transform(drop_unwanted)
        .transform(extract_remote)
        .transform(extract_place_names)
        .transform(extract_contract_type)
        .transform(extract_salaries)
        .withColumn("salary", F.struct(F.col("salary.currency").alias("currency")))
        .drop("location")
    )
    kept = extracted.transform(drop_duplicates, keys, order).transform(keep_currency).drop("salary")
    if max_places is not None and max_places <= VALUE_PLACES:
        placed = map_places(kept, gazetteer, countries=fixed.KEPT_COUNTRIES)
    else:
        placed = lookup_places(kept, gazetteer, keys, countries=fixed.KEPT_COUNTRIES, max_places=max_places)
    extra = [k for k in keys if k not in fixed.DOCUMENT_COLUMNS]
    return placed.transform(normalize_names).select(*extra, *fixed.DOCUMENT_COLUMNS)
