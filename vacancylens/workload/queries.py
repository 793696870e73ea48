"""The registered queries: one per operator family, over whole tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens.functions import text
from vacancylens.functions.numbers import row_mean
from vacancylens.functions.times import display_date, epoch_seconds, parse_iso
from vacancylens.operators import contracts, counts, filters, flatten, groups, ordering, places
from vacancylens.operators.distribution import describe
from vacancylens.plans import clean, cube, insights, profile, tables
from vacancylens.plans.pipeline import archive, run_pipeline
from vacancylens.session import configure, new_folder
from vacancylens.sources import lake, pages, retention, snapshots, warehouse
from vacancylens.streaming.ingest import ingest_new_snapshots
from vacancylens.workload import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    """Round averages and interpolated values; nothing else is rounded."""
    return df.withColumns({n: F.round(n, digits) for n in names})


SUMMARY = ["mean", "stddev", "p25", "p50", "p75"]

# ---- insights ---------------------------------------------------------------


@query
def technology_share(spark, sf_dir):
    return insights.technology_share(view.documents(spark, sf_dir, "technology"))


@query
def category_share(spark, sf_dir):
    return insights.category_share(view.documents(spark, sf_dir, "category"), n=3)


@query
def seniority_share(spark, sf_dir):
    return insights.seniority_share(view.documents(spark, sf_dir, "seniority"))


@query
def remote_share(spark, sf_dir):
    return insights.remote_share(view.documents(spark, sf_dir, "remote"))


@query
def category_technology_flow(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "category", "technology")
    return insights.category_technology_flow(docs, n_categories=3, n_technologies=12, min_flow=90)


@query
def flow_nodes(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "category", "technology")
    return insights.category_technology_nodes(docs, n_categories=3, n_technologies=12, min_flow=90)


def _city_columns(spark, sf_dir):
    return view.documents(spark, sf_dir, "id", "seniority", "salary_mean", "city")


def _rounded_cities(df):
    return rounded(df, "salary_mean", "lat", "lon", digits=3)


@query
def salary_by_city(spark, sf_dir):
    return _rounded_cities(insights.salary_by_city(_city_columns(spark, sf_dir)))


@query
def salary_by_city_junior(spark, sf_dir):
    return _rounded_cities(insights.salary_by_city_junior(_city_columns(spark, sf_dir)))


@query
def salary_by_city_mid(spark, sf_dir):
    return _rounded_cities(insights.salary_by_city_mid(_city_columns(spark, sf_dir)))


@query
def salary_by_city_senior(spark, sf_dir):
    return _rounded_cities(insights.salary_by_city_senior(_city_columns(spark, sf_dir)))


@query
def salary_by_city_min_jobs(spark, sf_dir):
    return _rounded_cities(insights.salary_by_city_min_jobs(_city_columns(spark, sf_dir), 1500))


def _min_jobs_of(seniority):
    def run(spark, sf_dir):
        return _rounded_cities(insights.salary_by_city_min_jobs(_city_columns(spark, sf_dir), 950, seniority))

    run.__name__ = f"salary_by_city_min_jobs_{seniority.lower()}"
    return query(run)


salary_by_city_min_jobs_junior = _min_jobs_of("Junior")
salary_by_city_min_jobs_mid = _min_jobs_of("Mid")
salary_by_city_min_jobs_senior = _min_jobs_of("Senior")


@query
def salary_histogram(spark, sf_dir):
    return insights.salary_histogram(view.documents(spark, sf_dir, "seniority", "salary_mean"))


def _salary_columns(spark, sf_dir):
    return view.documents(spark, sf_dir, "technology", "seniority", "contract_type", "salary_mean")


@query
def technology_salary_distribution(spark, sf_dir):
    found = insights.technology_salary_distribution(_salary_columns(spark, sf_dir), more_than=300)
    return rounded(found, *SUMMARY)


@query
def technology_salary_distribution_all_groups(spark, sf_dir):
    found = insights.technology_salary_distribution(_salary_columns(spark, sf_dir), limit=40000, more_than=0)
    return rounded(found, *SUMMARY)


@query
def technology_salary_shape(spark, sf_dir):
    return insights.technology_salary_shape(_salary_columns(spark, sf_dir))


@query
def contract_salary_distribution(spark, sf_dir):
    return rounded(insights.contract_salary_distribution(_salary_columns(spark, sf_dir)), *SUMMARY)


@query
def contract_salary_distribution_raw_names(spark, sf_dir):
    """The variant over contract names that were never capitalised."""
    docs = _salary_columns(spark, sf_dir).withColumn("contract_type", F.lower("contract_type"))
    found = insights.contract_salary_distribution(docs, n=5, contracts=("b2b", "permanent"))
    return rounded(found, *SUMMARY)


@query
def contract_salary_shape(spark, sf_dir):
    return insights.contract_salary_shape(_salary_columns(spark, sf_dir))


@query
def salary_describe(spark, sf_dir):
    docs = view.documents(spark, sf_dir, *profile.SALARY_COLUMNS)
    return rounded(profile.salary_describe(docs), *profile.SALARY_COLUMNS)


@query
def salary_describe_above(spark, sf_dir):
    docs = view.documents(spark, sf_dir, *profile.SALARY_COLUMNS)
    return rounded(profile.salary_describe(docs, min_above=5000), *profile.SALARY_COLUMNS)


@query
def account_describe(spark, sf_dir):
    """Describe over negative and positive values."""
    return rounded(describe(view.table(spark, sf_dir, "customer"), ["c_acctbal"]), "c_acctbal")


@query
def crowded_describe(spark, sf_dir):
    """Describe over a column whose values lie close together, and one of few distinct values."""
    lines = view.table(spark, sf_dir, "lineitem")
    close = (F.lit(1000000.0) + F.col("l_extendedprice") / 1000).alias("price")
    return rounded(describe(lines.select(close, F.col("l_quantity").alias("quantity")), ["price", "quantity"]), "price", "quantity")


# ---- cleaning ---------------------------------------------------------------


def _cleaned(spark, sf_dir):
    postings, known = view.raw_postings(spark, sf_dir), view.gazetteer(spark, sf_dir)
    return clean.clean(postings, known, order=view.LINE_ORDER, max_places=places.measured_places(known))


@query
def clean_postings(spark, sf_dir):
    """All twelve cleaning steps; lists are joined to text for comparison."""
    cities = F.transform("city", lambda c: F.coalesce(c.getField("city"), F.lit("?")))
    return (
        _cleaned(spark, sf_dir)
        .withColumn("city", F.array_join(cities, ","))
        .withColumn("seniority", F.array_join("seniority", ","))
    )


@query
def clean_locations(spark, sf_dir):
    return tables.locations_table(_cleaned(spark, sf_dir))


@query
def clean_seniorities(spark, sf_dir):
    return tables.seniorities_table(_cleaned(spark, sf_dir))


@query
def clean_strings(spark, sf_dir):
    """The text functions one by one, on names of every table that has some."""
    names = (
        view.table(spark, sf_dir, "part")
        .select(F.concat("p_type", F.lit("/"), F.col("p_name")).alias("name"))
        .union(view.table(spark, sf_dir, "part").select(F.concat(F.lit("camelCase"), F.initcap("p_name"))))
        .union(view.table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 25, "react").otherwise("")))
        .union(view.table(spark, sf_dir, "customer").select(F.lower("c_mktsegment")))
        .union(view.table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") > 0, "Nan")))
    )
    replaced = text.replace_values(names, {"node.js": "node", "angular": "javascript", "react": "javascript"})
    shown = replaced.select(
        F.lower("name").alias("lowered"),
        text.split_before_capitals(F.col("name")).alias("split"),
        text.title_case(F.col("name")).alias("titled"),
        text.capitalize(F.col("name"), {"javascript": "JavaScript"}).alias("capitalized"),
        text.keyword(F.concat(F.lit(" \t"), F.col("name"), F.lit("\n"))).alias("keyword"),
    )
    return text.unify_missing(shown).groupBy(shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def row_means(spark, sf_dir):
    lines = view.table(spark, sf_dir, "lineitem")
    low, high = F.nullif(F.col("l_discount"), F.lit(0.0)), F.nullif(F.col("l_tax"), F.lit(0.0))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", row_mean(high, low).alias("mean"))


@query
def currency_filter(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "currency", "salary_mean", all_currencies=True)
    nested = docs.withColumn("salary", F.struct("currency"))
    return clean.keep_currency(nested).select("id", "currency", "salary_mean")


@query
def geo_lookup(spark, sf_dir):
    """Suppliers' nation names, some unknown and some foreign, to places."""
    suppliers = (
        view.table(spark, sf_dir, "supplier")
        .join(view.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.array(F.lower("n_name"), F.lit("nation_24 "), F.lit("Atlantis")).alias("place_names"))
    )
    found = places.lookup_places(suppliers, view.gazetteer(spark, sf_dir), ["s_suppkey"], countries=["Polska"])
    return found.select("s_suppkey", F.posexplode("city").alias("pos", "c")).select("s_suppkey", "pos", "c.*")


@query
def geo_lookup_joined(spark, sf_dir):
    """Cleaned places by the join that serves gazetteers of any size."""
    postings, known = view.raw_postings(spark, sf_dir), view.gazetteer(spark, sf_dir)
    return tables.locations_table(clean.clean(postings, known, order=view.LINE_ORDER))


@query
def address_gazetteer(spark, sf_dir):
    nations = view.table(spark, sf_dir, "nation").join(
        view.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = view.table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    addressed = customers.select(
        "c_name", F.concat_ws(" , ", "c_mktsegment", "n_name", "r_name").alias("address"), "c_acctbal"
    )
    return places.gazetteer_from_addresses(addressed, "c_name", "address", "c_acctbal", "c_acctbal")


# ---- deduplication, profile, groups -----------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def dedupe_first(spark, sf_dir):
    lines = view.table(spark, sf_dir, "lineitem")
    return groups.first_per_key(lines, _LINE_KEY, ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]).select(
        *_LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )


@query
def duplicate_members(spark, sf_dir):
    lines = view.table(spark, sf_dir, "lineitem").select(*_LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice")
    return groups.duplicate_members(lines, _LINE_KEY)


@query
def duplicate_profile(spark, sf_dir):
    return groups.duplicate_count(view.table(spark, sf_dir, "lineitem"), _LINE_KEY)


@query
def null_profile(spark, sf_dir):
    lines = view.table(spark, sf_dir, "lineitem")
    return counts.null_counts(
        lines.select(
            "l_orderkey",
            F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
            F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
            F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
        )
    )


@query
def row_counts(spark, sf_dir):
    return counts.row_count(view.table(spark, sf_dir, "lineitem"))


@query
def technology_counts(spark, sf_dir):
    return profile.frequent_values(view.raw_postings(spark, sf_dir), "technology", 30)


@query
def category_counts(spark, sf_dir):
    return counts.value_counts(view.raw_postings(spark, sf_dir), "category")


@query
def seniority_list_counts(spark, sf_dir):
    listed = counts.list_counts(view.documents(spark, sf_dir, "seniority"), "seniority")
    return listed.withColumn("seniority", F.array_join("seniority", ","))


@query
def top_technology_rows(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "technology")
    return counts.rows_with_top_values(docs, "technology", 5)


@query
def large_group_rows(spark, sf_dir):
    """Rows of the seniority and technology pairs with enough salaries."""
    docs = view.documents(spark, sf_dir, "id", "technology", "seniority", "salary_mean")
    rows = filters.explode_list(docs, "seniority")
    return groups.rows_of_large_groups(rows, ["seniority", "technology"], "technology", 330).drop("salary_mean")


@query
def salary_ranges(spark, sf_dir):
    """Open range, membership and equality filters together."""
    docs = view.documents(spark, sf_dir, "id", "technology", "contract_type", "remote", "salary_mean")
    inside = filters.keep_between(docs, F.col("salary_mean"), above=5000, below=20000)
    chosen = filters.keep_members(inside, F.col("technology"), ["Brand#1", "Brand#2", "Brand#3"])
    return filters.keep_equal(chosen, F.col("contract_type"), "B2B").withColumn("remote", text.yes_no(F.col("remote")))


@query
def seniority_sorted(spark, sf_dir):
    """Postings and levels in seniority order, with the rank that sorts them."""
    docs = filters.explode_list(view.documents(spark, sf_dir, "id", "seniority"), "seniority")
    rank = ordering.rank_of(F.col("seniority"), ordering.SENIORITY_ORDER)
    return ordering.sort_by_seniority(docs, "id").withColumn("seniority_rank", rank)


# ---- warehouse tables and contracts -----------------------------------------


@query
def postings_table(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "name", "posted", "title", "technology", "category", "url", "remote")
    table = contracts.validate(tables.postings_table(docs), contracts.POSTINGS)[0]
    return table.withColumn("posted", F.date_format("posted", "yyyy-MM-dd HH:mm:ss"))


@query
def salaries_table(spark, sf_dir):
    docs = view.documents(spark, sf_dir, *tables.fixed.SALARIES_COLUMNS)
    return contracts.validate(tables.salaries_table(docs), contracts.SALARIES)[0]


@query
def locations_table(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "city")
    return contracts.validate(tables.locations_table(docs), contracts.LOCATIONS)[0]


@query
def seniorities_table(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "seniority")
    return contracts.validate(tables.seniorities_table(docs), contracts.SENIORITIES)[0]


@query
def contract_violations(spark, sf_dir):
    """Customers as documents that break most rules; one id is very frequent."""
    balance = F.col("c_acctbal")
    docs = view.table(spark, sf_dir, "customer").select(
        F.when(balance < 0, "debtor").otherwise(F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.when(balance < 5000, "not a date").alias("posted"),
        *[F.lit(None).cast("string").alias(c) for c in ("title", "technology", "category", "url")],
        F.when(balance > 100, F.lit("yes")).alias("remote"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("contract_type"),
        balance.alias("salary_min"),
        F.when(balance > 9000, "much").otherwise("100").alias("salary_max"),
        balance.alias("salary_mean"),
        F.array(
            F.struct(F.col("c_mktsegment").alias("city"), (balance / 50).alias("lat"), (balance / -50).alias("lon"))
        ).alias("city"),
        F.array(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))).alias("seniority"),
    )
    return tables.all_violations(docs)


@query
def warehouse_roundtrip(spark, sf_dir):
    """Write, publish and read back the relational tables of one snapshot."""
    path, key = new_folder(spark, "warehouse"), "1704067200_nofluffjobs"
    docs = view.documents(spark, sf_dir)
    metadata = spark.sql("SELECT 'nofluffjobs' AS source_name, TIMESTAMP'2024-01-01 00:00:00' AS obtained_datetime")
    run = warehouse.new_run()
    warehouse.write_documents(metadata, docs, path, run)
    warehouse.publish(metadata, path, key, run)
    _, served = warehouse.read_documents(spark, path)
    warehouse.write_warehouse(tables.warehouse_tables(served), path, run)
    seniorities = warehouse.read_served(spark, path, "seniorities")
    levels = seniorities.groupBy("id").agg(F.count("seniority").alias("n_levels"))
    cities = warehouse.read_served(spark, path, "locations").groupBy("id").agg(F.count("city").alias("n_cities"))
    salaries = warehouse.read_served(spark, path, "salaries")
    return salaries.join(levels, "id", "left").join(cities, "id", "left")


# ---- snapshots --------------------------------------------------------------


def _shown(postings: DataFrame) -> DataFrame:
    return postings.select(
        "key", "pos", "id", "name", "posted", "technology", "location.fullyRemote",
        F.col("salary").getField("to").alias("salary_to"),
        F.col("location.places")[0]["city"].alias("first_city"),
    )


@query
def snapshot_roundtrip(spark, sf_dir):
    """Events packed into envelopes, parsed, checked and unpacked again."""
    return _shown(snapshots.extract(view.event_envelopes(spark, sf_dir))[1])


@query
def snapshot_metadata(spark, sf_dir):
    envelopes = view.event_envelopes(spark, sf_dir)
    parsed = snapshots.read_snapshot(envelopes).transform(snapshots.check_source)
    return parsed.select(
        "source_name",
        "key",
        epoch_seconds(F.col("obtained_datetime")).alias("obtained"),
        display_date(F.col("obtained_datetime")).alias("shown"),
        F.size("raw_data.postings").alias("n_postings"),
    )


@query
def snapshot_freshness(spark, sf_dir):
    metadata, _ = snapshots.extract(view.event_envelopes(spark, sf_dir))
    return insights.freshness(metadata).groupBy("source_name", "obtained").agg(F.count(F.lit(1)).alias("n"))


@query
def envelope_json(spark, sf_dir):
    """Parsed snapshots written as envelope text once more and read back."""
    parsed = snapshots.read_snapshot(view.event_envelopes(spark, sf_dir))
    again = parsed.select(
        snapshots.to_envelope_json(F.col("source_name"), F.col("obtained_datetime"), F.col("raw_data")).alias("payload")
    )
    return _shown(snapshots.extract(again)[1])


@query
def archive_roundtrip(spark, sf_dir):
    """All snapshots written to the lake, every one twice, and read back."""
    path = new_folder(spark, "lake")
    envelopes = view.event_envelopes(spark, sf_dir)
    archive(envelopes, path)
    archive(envelopes, path)
    return _shown(snapshots.extract(lake.read_lake(spark, path).select("payload"))[1])


@query
def lake_postings(spark, sf_dir):
    """All snapshots archived in two batches with some in both, read as rows of postings."""
    path, envelopes = new_folder(spark, "lake"), view.event_envelopes(spark, sf_dir)
    archive(envelopes, path)
    archive(envelopes.where(F.col("path").cast("int") % 2 == 0), path)
    return _shown(lake.read_postings(spark, path))


@query
def compacted_lake(spark, sf_dir):
    """Postings of a lake whose batches, one of them a repetition, were merged into one."""
    path, envelopes = new_folder(spark, "lake"), view.event_envelopes(spark, sf_dir)
    archive(envelopes, path)
    archive(envelopes.where(F.col("path").cast("int") % 2 == 1), path)
    retention.compact_lake(spark, path, older_than=0)
    retention.compact_lake(spark, path, older_than=0)
    return _shown(lake.read_postings(spark, path))


@query
def archived_heads(spark, sf_dir):
    """The lake's manifest after one batch came twice under its name and once under another."""
    path, envelopes = new_folder(spark, "lake"), view.event_envelopes(spark, sf_dir)
    for batch in ("first", "first", "second"):
        archive(envelopes, path, batch=batch)
    heads = lake.read_heads(spark, path)
    return heads.select("source_name", "key", epoch_seconds(F.col("obtained_datetime")).alias("obtained"), "n_postings", F.size("payload_files").alias("n_files"))


def _land(spark, sf_dir, path):
    """Write the envelopes as text files with one envelope per line."""
    view.event_envelopes(spark, sf_dir).select("payload").write.text(path)


@query
def landing_snapshots(spark, sf_dir):
    """Bare responses read from a landing folder and wrapped into envelopes."""
    path = new_folder(spark, "landing")
    raw = view.event_envelopes(spark, sf_dir).select(F.get_json_object("payload", "$.raw_data").alias("raw"))
    raw.write.text(path)
    landed = snapshots.read_landing(spark, path, lines=True)
    return _shown(snapshots.extract(landed)[1]).drop("key")


@query
def incremental_ingest(spark, sf_dir):
    """Streaming ingestion run twice; the second run finds nothing new."""
    landing, path, stored = (new_folder(spark, p) for p in ("landing", "warehouse", "lake"))
    checkpoint = new_folder(spark, "ingest")
    _land(spark, sf_dir, landing)
    for _ in range(2):
        ingest_new_snapshots(
            spark, landing, view.warsaw(spark), path, stored, checkpoint, lines=True, relational=False, insights=False
        ).awaitTermination()
    return _shown(snapshots.extract(lake.read_lake(spark, stored).select("payload"))[1])


@query
def latest_snapshot(spark, sf_dir):
    """The documents served after ingesting every snapshot: those of the newest."""
    landing, path, stored = (new_folder(spark, p) for p in ("landing", "warehouse", "lake"))
    _land(spark, sf_dir, landing)
    ingest_new_snapshots(
        spark, landing, view.warsaw(spark), path, stored, new_folder(spark, "ingest"), lines=True, insights=False
    ).awaitTermination()
    _, documents = warehouse.read_documents(spark, path)
    city = F.col("city")[0]["city"].alias("city")
    return documents.select("id", "technology", "remote", "contract_type", "salary_mean", city)


@query
def landing_archive(spark, sf_dir):
    """Bare responses that land in one second, archived through ingestion: all are kept."""
    landing, path, stored = (new_folder(spark, p) for p in ("landing", "warehouse", "lake"))
    raw = view.event_envelopes(spark, sf_dir).select(F.get_json_object("payload", "$.raw_data").alias("raw"))
    raw.write.text(landing)
    _set_times(spark, landing, 1704067200)
    ingest_new_snapshots(
        spark, landing, view.warsaw(spark), path, stored, new_folder(spark, "ingest"),
        lines=True, relational=False, raw=True, insights=False,
    ).awaitTermination()
    return _shown(snapshots.extract(lake.read_lake(spark, stored).select("payload"))[1]).drop("key")


def _set_times(spark, path, second):
    """Give the files of a folder one time, as if they had landed together."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        files.setTimes(status.getPath(), second * 1000, -1)


@query
def large_snapshot(spark, sf_dir):
    """One snapshot of all events that lands as posting lines: archived, cleaned and served by rows."""
    landing, path, stored = (new_folder(spark, p) for p in ("landing", "warehouse", "lake"))
    view.event_posting_lines(spark, sf_dir).write.text(landing)
    ingest_new_snapshots(
        spark, landing, view.warsaw(spark), path, stored, new_folder(spark, "ingest"), insights=False, posting_lines=True
    ).awaitTermination()
    _, documents = warehouse.read_documents(spark, path)
    return documents.select("id", "technology", "remote", "contract_type", "salary_mean", "posted")


@query
def repeated_batch(spark, sf_dir):
    """One batch run twice under its name: published once, archived once."""
    path, stored, envelopes = new_folder(spark, "warehouse"), new_folder(spark, "lake"), view.event_envelopes(spark, sf_dir)
    for _ in range(2):
        run_pipeline(spark, envelopes, view.warsaw(spark), path, stored, relational=False, insights=False, batch="stream-7")
    runs = warehouse.published_runs(spark, path)
    postings = lake.read_postings(spark, stored).groupBy("key").agg(F.count(F.lit(1)).alias("n_postings"))
    return postings.withColumns({"n_runs": runs.agg(F.count("run")).scalar(), "batch": runs.agg(F.max("batch")).scalar()})


def _serve_in_two_parts(spark, sf_dir):
    """The warehouse after two ingestions of all snapshots but their half each."""
    landing, path, stored = (new_folder(spark, p) for p in ("landing", "warehouse", "lake"))
    checkpoint, envelopes = new_folder(spark, "ingest"), view.event_envelopes(spark, sf_dir).select("payload")
    first = F.pmod(F.xxhash64("payload"), F.lit(2)) == 0
    for part in (first, ~first):
        envelopes.where(part).write.mode("append").text(landing)
        ingest_new_snapshots(
            spark, landing, view.warsaw(spark), path, stored, checkpoint, lines=True, relational=False
        ).awaitTermination()
    return path


@query
def served_insights(spark, sf_dir):
    """Stored insights after two ingestions, of the snapshot then served."""
    return warehouse.read_served(spark, _serve_in_two_parts(spark, sf_dir), "insight_remote_share")


#: What tells an insight's rows apart, its count, and a number to show with it.
_SHOWN = {
    "technology_share": (["technology"], "n", "share", 6),
    "category_share": (["category"], "n", "share", 6),
    "seniority_share": (["seniority"], "n", "share", 6),
    "remote_share": (["remote"], "n", "share", 6),
    "category_technology_flow": (["category", "technology"], "n", None, 0),
    "category_technology_nodes": (["label"], "node_id", None, 0),
    **{f"salary_by_city{level}": (["city"], "job_counts", "salary_mean", 3) for level in ("", "_junior", "_mid", "_senior")},
    "salary_histogram": (["seniority", "bin_start"], "n", None, 0),
    "technology_salary_distribution": (["seniority", "technology"], "n", "p50", 4),
    "contract_salary_distribution": (["contract_type", "technology"], "n", "p50", 4),
    "technology_salary_shape": (["seniority", "technology", "bin_start"], "n", None, 0),
    "contract_salary_shape": (["contract_type", "technology", "bin_start"], "n", None, 0),
}


def _one_table(found):
    """Insights, each with its own columns, as rows ``(insight, label, n, value)``."""
    tables_ = []
    for name, (label, n, value, digits) in _SHOWN.items():
        number = F.lit(None).cast("double") if value is None else F.round(value, digits)
        label = F.concat_ws("/", *[F.col(c).cast("string") for c in label])
        tables_.append(found[name].select(F.lit(name).alias("insight"), label.alias("label"), F.col(n).cast("long").alias("n"), number.alias("value")))
    return reduce(DataFrame.unionByName, tables_)


@query
def served_insight_tables(spark, sf_dir):
    """Every insight stored with the snapshot that is served after two ingestions."""
    path = _serve_in_two_parts(spark, sf_dir)
    run = warehouse.require_served(spark, path).run
    return _one_table({name: warehouse.read_written(spark, path, run, f"insight_{name}") for name in _SHOWN})


@query
def cube_insights(spark, sf_dir):
    """Every insight from the cube, with its defaults."""
    docs = view.documents(spark, sf_dir, "id", "technology", "category", "remote", "contract_type", "salary_mean", "city", "seniority")
    path = new_folder(spark, "cube")
    cube.insight_cube(docs).write.parquet(path)
    return _one_table(cube.insights_of_cube(spark.read.parquet(path), docs))


@query
def latest_event_per_user(spark, sf_dir):
    """Newest row wins, per key."""
    events = view.table(spark, sf_dir, "events")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return groups.first_per_key(events, ["user_id"], order).select("user_id", "event_id", "event_type", "value")


@query
def clean_several_snapshots(spark, sf_dir):
    """Cleaning of all snapshots at once, each deduplicated by itself."""
    _, postings = snapshots.extract(view.event_envelopes(spark, sf_dir))
    cleaned = clean.clean(postings, view.warsaw(spark), keys=("key", "id"))
    return cleaned.groupBy("key", "technology", "remote").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("salary_mean"), 4).alias("salary_sum")
    )


@query
def iso_times(spark, sf_dir):
    """Timestamps to text, back, and to the key's epoch."""
    orders = view.table(spark, sf_dir, "orders")
    told = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return orders.select("o_orderkey", told.alias("told")).select(
        "o_orderkey",
        "told",
        epoch_seconds(parse_iso(F.col("told"))).alias("epoch"),
        display_date(parse_iso(F.col("told"))).alias("shown"),
    )


@query
def head_rows(spark, sf_dir):
    """The first rows of a stated order, ties included in it."""
    orders = view.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return filters.head(orders, 12, F.col("o_totalprice").desc(), "o_orderkey")


@query
def flatten_documents(spark, sf_dir):
    nested = view.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_totalprice").alias("total"), F.col("o_custkey").alias("by")).alias("price"),
        ).alias("order"),
    )
    return flatten.flatten_structs(nested, separator="_")


# ---- pages ------------------------------------------------------------------


@query
def page_keywords(spark, sf_dir):
    return pages.flat_keywords(view.table(spark, sf_dir, "pages"), "ad")


@query
def page_keywords_nested(spark, sf_dir):
    """The parsing variant, in a container only, with nested markup and a void element."""
    given = view.table(spark, sf_dir, "pages")
    nested = F.regexp_replace("html", '<div class="ad">([^<]*)</div>', '<div class="x ad"><p><b>$1</b><br>&amp; more</p></div>')
    before = F.lit('<div class="ad">outside</div><div id="posting-requirements">')
    html = F.concat(before, nested, F.lit('</div><div class="ad">after</div>'))
    return pages.page_keywords(given.select("page_id", html.alias("html")), "ad")


@query
def posting_keywords(spark, sf_dir):
    """Keywords of the pages behind postings; every third posting has no page."""
    given = view.table(spark, sf_dir, "pages")
    slug = F.concat(F.lit("page-"), F.col("page_id"))
    postings = given.select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 3 == 0, "gone").otherwise(slug).alias("url"))
    reached = snapshots.posting_url(given.select(slug.alias("url"), "html"), "page_url")
    return pages.posting_keywords(postings, reached.select(F.col("page_url").alias("url"), "html"), "ad", None)


@query
def posting_urls(spark, sf_dir):
    docs = view.documents(spark, sf_dir, "id", "url")
    return snapshots.posting_url(docs).select("id", "page_url")
