"""Place lookup: city names as posted to canonical city, latitude, longitude."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens.functions.text import address_city_country, place_key
from vacancylens.operators.bounded import broadcast_bounded, measured_rows

#: A lookup table of at most this many rows (some 20 MB) may be broadcast.
BROADCAST_PLACES = 200_000

#: A lookup table of at most this many rows (some 2 MB) may be one value of a query,
#: in this many buckets, each a map.
VALUE_PLACES, BUCKETS = 20_000, 1024

_CITY = "struct<city:string,lat:double,lon:double>"


def gazetteer_from_addresses(df: DataFrame, alias: str, address: str, lat: str, lon: str) -> DataFrame:
    """Gazetteer rows from full address strings such as ``city, region, country``."""
    city, country = address_city_country(F.col(address))
    return df.select(
        F.col(alias).alias("alias"),
        city.alias("city"),
        country.alias("country"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
    )


def lookup_table(gazetteer: DataFrame, countries: Sequence[str] | None) -> DataFrame:
    """One row per normalised alias, limited to ``countries``.

    An alias given twice resolves to one place (its smallest row) before the
    country is looked at, so a foreign best match is not replaced.
    """
    table = gazetteer.groupBy(place_key(F.col("alias")).alias("_alias")).agg(
        F.min(F.struct("city", "country", "lat", "lon")).alias("_place")
    )
    if countries is not None:
        table = table.where(F.col("_place.country").isin(list(countries)))
    return table.where(F.col("_alias").isNotNull()).select(
        "_alias", *[F.col("_place").getField(name).alias(f"_{name}") for name in ("city", "lat", "lon")]
    )


def measured_places(gazetteer: DataFrame) -> int | None:
    """Rows of a gazetteer small enough to broadcast, else None. Runs a count."""
    return measured_rows(gazetteer, BROADCAST_PLACES)


def places_in_use(gazetteer: DataFrame, df: DataFrame, names: str = "place_names") -> DataFrame:
    """The rows of a large gazetteer that some row of ``df`` asks for.

    Names repeat far more than they differ, so their distinct values combine
    before the shuffle and usually leave little to look up.
    """
    asked = df.select(F.explode(names).alias("_name")).select(place_key(F.col("_name")).alias("_asked")).distinct()
    return gazetteer.join(asked, place_key(F.col("alias")) == F.col("_asked"), "left_semi")


def place_names(location: Column) -> Column:
    """Names of the places that have a city, in the order given."""
    return F.array_compact(location.getField("places").getField("city"))


def lookup_places(
    df: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str],
    names: str = "place_names",
    into: str = "city",
    countries: Sequence[str] | None = None,
    max_places: int | None = None,
) -> DataFrame:
    """Replace the array ``names`` by an array of ``(city, lat, lon)``.

    ``df`` must be unique on ``keys``. An unknown or foreign place becomes a
    struct of NULLs and keeps its position; an empty list stays empty.

    With ``max_places``, as found by :func:`measured_places`, a small gazetteer
    is broadcast; otherwise Spark decides, and splits hot names if it shuffles.
    Input that is already partitioned by ``keys`` (the output of a
    deduplication) is then regrouped without another shuffle. A group is the
    places of one posting.
    """
    others = [c for c in df.columns if c not in keys and c != names]
    table = lookup_table(gazetteer, countries)
    unfolded = df.select(*keys, *others, F.posexplode_outer(names).alias("_place_pos", "_name"))
    table = broadcast_bounded(table, max_places, BROADCAST_PLACES)
    found = unfolded.join(table, place_key(F.col("_name")) == F.col("_alias"), "left")
    place = F.struct("_place_pos", F.col("_city").alias("city"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))
    regrouped = found.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in others],
        F.collect_list(F.when(F.col("_place_pos").isNotNull(), place)).alias("_places"),
    )
    cities = F.transform(
        F.array_sort("_places"),
        lambda p: F.struct(*[p.getField(name).alias(name) for name in ("city", "lat", "lon")]),
    )
    return regrouped.select(*keys, *others, cities.cast(f"array<{_CITY}>").alias(into))


def _bucket(alias: Column) -> Column:
    return F.pmod(F.xxhash64(alias), F.lit(BUCKETS)).cast("int")


def _table_value(table: DataFrame) -> Column:
    """A lookup table as one value: an array of maps from alias to place.

    Spark searches a map from its beginning, so the aliases are spread over buckets
    and a lookup sees a few of them.
    """
    place = F.struct(F.col("_city").alias("city"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))
    maps = table.groupBy(_bucket(F.col("_alias")).alias("at")).agg(F.map_from_entries(F.collect_list(F.struct("_alias", place))).alias("places"))
    by_bucket = F.map_from_entries(F.collect_list(F.struct("at", "places")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda at: F.col("by")[at])
    return maps.agg(by_bucket.alias("by")).select(dense.alias("table")).scalar()


def map_places(
    df: DataFrame, gazetteer: DataFrame, names: str = "place_names", into: str = "city", countries: Sequence[str] | None = None
) -> DataFrame:
    """:func:`lookup_places` for a gazetteer of at most ``VALUE_PLACES`` rows.

    The table is one value, computed once and sent with the tasks, and each list is
    mapped where it is: rows are neither unfolded nor grouped, so they need no key.
    """
    missing = F.struct(F.lit(None).cast("string").alias("city"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    held = df.withColumn("_table", _table_value(lookup_table(gazetteer, countries)))

    def found(name: Column) -> Column:
        key = place_key(name)
        return F.coalesce(F.col("_table")[_bucket(key)][key], missing)

    cities = F.transform(F.coalesce(F.col(names), F.array().cast("array<string>")), found)
    placed = held.withColumn(into, cities.cast(f"array<{_CITY}>"))
    return placed.drop("_table", *([names] if names != into else []))
