"""Job postings derived from the TPC-H-like tables.

The given tables hold no postings, so orders stand for postings and their lines
for the details. Two shapes are needed: cleaned documents, which the insight
queries read, and raw nested postings with repeated ids, which cleaning reads.
``oracles.py`` states both in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens.functions.numbers import row_mean
from vacancylens.fixed_values import DOCUMENT_COLUMNS
from vacancylens.plans.clean import normalize_names
from vacancylens.schemas import POSTING

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


#: Schemas of the given tables. Stating them saves a job per table that only
#: reads a file footer while the plan is built.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(column: str):
    """Epoch milliseconds of a zone-less timestamp, in any session time zone."""
    return F.expr(f"timestampdiff(MILLISECOND, {_EPOCH}, {column})")


def _latitude(nation_key):
    return F.lit(49.0) + nation_key * F.lit(0.25)


def _longitude(nation_key):
    return F.lit(14.0) + nation_key * F.lit(0.5)


def documents(spark: SparkSession, sf_dir: str, *columns: str, all_currencies: bool = False) -> DataFrame:
    """One cleaned document per order with lines, limited to ``columns``.

    Only the joins the wanted columns need are made. Levels come from three
    flags and places from the fixed set of nations, so both lists are bounded.
    """
    wanted = set(columns or DOCUMENT_COLUMNS)
    needs_part = bool(wanted & {"title", "technology", "category"})
    needs_city = "city" in wanted

    lines = table(spark, sf_dir, "lineitem")
    if needs_city:
        nations = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"),
            F.struct(
                F.col("n_name").alias("city"),
                _latitude(F.col("n_nationkey")).alias("lat"),
                _longitude(F.col("n_nationkey")).alias("lon"),
            ).alias("_city"),
        )
        suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        lines = lines.join(suppliers.join(nations, "s_nationkey"), "l_suppkey")

    flag = F.col("l_returnflag")
    levels = [
        F.when(F.bool_or(condition), F.lit(level))
        for level, condition in (("Junior", flag == "N"), ("Mid", flag == "A"), ("Senior", flag == "R"))
    ]
    details = {
        "_low": F.min("l_extendedprice") / 4.1,
        "_high": F.max("l_extendedprice") / 1.7,
        "contract_type": F.when(F.bool_and(F.col("l_linestatus") == "O"), "B2B").otherwise("Permanent"),
        "p_partkey": F.min("l_partkey"),
        "seniority": F.array_compact(F.array(*levels)),
    }
    if needs_city:
        details["city"] = F.array_sort(F.collect_set("_city"))
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[value.alias(name) for name, value in details.items()]
    )

    orders = table(spark, sf_dir, "orders")
    if not all_currencies:
        orders = orders.where(F.col("o_orderpriority") != "5-LOW")
    rows = orders.join(per_order, "o_orderkey")
    if needs_part:
        rows = rows.join(_named_parts(spark, sf_dir), "p_partkey")
    if "name" in wanted:
        rows = rows.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))

    built = {
        "id": F.col("o_orderkey").cast("string"),
        "name": F.col("c_name") if "name" in wanted else None,
        "posted": epoch_millis("o_orderdate"),
        "title": F.col("title") if needs_part else None,
        "technology": F.col("technology") if needs_part else None,
        "category": F.col("category") if needs_part else None,
        "url": F.concat(F.lit("offer-"), F.col("o_orderkey").cast("string")),
        "remote": F.col("o_orderstatus") == "O",
        "contract_type": F.col("contract_type"),
        "salary_min": F.col("_low"),
        "salary_max": F.col("_high"),
        "salary_mean": row_mean(F.col("_high"), F.col("_low")),
        "city": F.col("city") if needs_city else None,
        "seniority": F.col("seniority"),
        "currency": F.when(F.col("o_orderpriority") == "5-LOW", "EUR").otherwise("PLN"),
    }
    return rows.select(*[value.alias(name) for name, value in built.items() if name in wanted])


def _named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with cleaned names: the text steps run once per part, not per order."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("technology"),
        F.lower("p_type").alias("category"),
        F.lit(None).cast("string").alias("contract_type"),
    )
    return normalize_names(parts).drop("contract_type")


#: The order in which the lines of one order count as its postings.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]

_TECHNOLOGIES = {
    "Brand#1": "Node.js",
    "Brand#2": "React",
    "Brand#3": "Angular",
    "Brand#4": ".NET",
    "Brand#5": "AWS",
    "Brand#6": "iOS",
    "Brand#7": "PHP",
    "Brand#8": "SQL",
    "Brand#9": "",
    "Brand#10": "NaN",
    "Brand#11": None,
}
_CATEGORIES = {
    "MEDIUM": "businessAnalyst",
    "LARGE": "projectManager",
    "SMALL": "ux/ui",
    "PROMO": "devOPS",
    "ECONOMY": "backend",
}


def _case(column: str, cases: dict, otherwise):
    value = F.when(F.lit(False), F.lit(None).cast("string"))
    for text, result in cases.items():
        value = value.when(F.col(column) == text, F.lit(result).cast("string"))
    return value.otherwise(otherwise)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw posting per order line, in the extracted nested shape.

    Lines of an order repeat its id; :data:`LINE_ORDER` is their order.
    """
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )

    def place(city):
        return F.struct(city.alias("city"))

    second = F.concat(F.lit(" nation_"), F.pmod(F.col("l_quantity").cast("int"), F.lit(30)).cast("string"))
    places = F.when(F.col("l_linenumber") == 7, F.array().cast("array<struct<city:string>>")).otherwise(
        F.array(place(F.col("n_name")), place(F.when(F.pmod("l_linenumber", F.lit(3)) != 0, second)))
    )
    built = {
        "id": F.col("o_orderkey").cast("string"),
        "name": F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")),
        "location": F.struct(places.alias("places"), (F.col("o_orderstatus") == "O").alias("fullyRemote")),
        "posted": epoch_millis("o_orderdate"),
        "title": F.when(F.col("p_name") == "old bolt", "react").otherwise(F.col("p_name")),
        "technology": _case("p_brand", _TECHNOLOGIES, F.col("p_brand")),
        "category": _case("p_type", _CATEGORIES, F.lit("it's QAOps")),
        "seniority": F.when(F.col("l_returnflag") == "N", F.array(F.lit("Junior")))
        .when(F.col("l_returnflag") == "A", F.array(F.lit("Senior"), F.lit("Mid")))
        .otherwise(F.array().cast("array<string>")),
        "url": F.concat_ws("-", F.lit("offer"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")]),
        "salary": F.struct(
            F.when(F.col("l_discount") != 0, F.col("l_extendedprice") / 4).alias("from"),
            F.when(F.col("l_tax") != 0, F.col("l_extendedprice") / 1.5).alias("to"),
            F.when(F.col("l_linestatus") == "O", "b2b")
            .when(F.col("l_quantity") > 10, "permanent")
            .otherwise("")
            .alias("type"),
            F.when(F.pmod("l_linenumber", F.lit(4)) == 0, "EUR").otherwise("PLN").alias("currency"),
        ),
    }
    # Fields of a posting that nothing downstream looks at.
    unused = {f.name: F.lit(None).cast(f.dataType) for f in POSTING if f.name not in built}
    return rows.select(*[value.alias(name) for name, value in (built | unused).items()], *LINE_ORDER)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alias per nation but one; the nations of one region are foreign."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") != 3)
        .select(
            F.col("n_name").alias("alias"),
            F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
            F.when(F.col("n_regionkey") == 0, "Deutschland").otherwise("Polska").alias("country"),
            _latitude(F.col("n_nationkey")).alias("lat"),
            _longitude(F.col("n_nationkey")).alias("lon"),
        )
    )


#: Events per snapshot envelope: event ids are unique, so an envelope is bounded.
ENVELOPE_EVENTS = 2000


def _event_posting() -> Column:
    return F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
        epoch_millis("ts").alias("posted"),
        F.col("event_type").alias("title"),
        F.col("event_type").alias("technology"),
        F.lit("backend").alias("category"),
        F.struct(
            F.array(F.struct(F.lit("Warsaw").alias("city"))).alias("places"),
            (F.col("event_type") == "view").alias("fullyRemote"),
        ).alias("location"),
        F.array(F.lit("Mid")).alias("seniority"),
        F.struct(
            F.col("value").alias("from"),
            (F.col("value") * 2).alias("to"),
            F.lit("b2b").alias("type"),
            F.when(F.col("event_type") == "error", "EUR").otherwise("PLN").alias("currency"),
        ).alias("salary"),
    )


def _event_metadata(obtained: Column) -> Column:
    return F.struct(
        F.lit("nofluffjobs").alias("source_name"),
        F.date_format(obtained, "yyyy-MM-dd HH:mm:ss").alias("obtained_datetime"),
    )


def event_posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one snapshot in posting lines, and the line that announces their number."""
    events = table(spark, sf_dir, "events")
    metadata = _event_metadata(F.timestamp_seconds(F.lit(1704067200))).alias("metadata")
    lines = events.select(F.to_json(F.struct(metadata, F.col("event_id").cast("int").alias("pos"), _event_posting().alias("posting"))).alias("value"))
    announced = events.agg(F.count(F.lit(1)).alias("totalCount"))
    return lines.unionByName(announced.select(F.to_json(F.struct(metadata, "totalCount")).alias("value")))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope texts over all events, each with a fixed number of postings."""
    chunk = F.floor(F.col("event_id") / ENVELOPE_EVENTS)
    packed = (
        table(spark, sf_dir, "events")
        .groupBy(chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("event_id", _event_posting().alias("posting")))).alias("_sorted"))
    )
    raw_data = F.struct(
        F.transform("_sorted", lambda e: e.getField("posting")).alias("postings"),
        F.size("_sorted").cast("long").alias("totalCount"),
    )
    obtained = F.timestamp_seconds(F.lit(1704067200) + F.col("chunk") * 3600)
    return packed.select(
        F.to_json(F.struct(_event_metadata(obtained).alias("metadata"), raw_data.alias("raw_data"))).alias("payload"),
        obtained.alias("modified"),
        F.col("chunk").cast("string").alias("path"),
    )


def warsaw(spark: SparkSession) -> DataFrame:
    """The one-row gazetteer the event postings need."""
    return spark.sql("SELECT 'Warsaw' AS alias, 'Warszawa' AS city, 'Polska' AS country, 52.23D AS lat, 21.01D AS lon")
