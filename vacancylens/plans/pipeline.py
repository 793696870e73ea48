"""One run: archive new snapshots, clean the newest, serve its tables."""

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.functions.times import epoch_seconds
from vacancylens.operators import places
from vacancylens.plans.clean import clean, extract_place_names
from vacancylens.plans.cube import insight_cube, insights_of_cube
from vacancylens.plans.tables import ObservedContracts, warehouse_tables
from vacancylens.session import new_folder
from vacancylens.sources import snapshots as snap
from vacancylens.sources import warehouse
from vacancylens.sources.lake import Archived, archive_batch, load_postings, read_heads

log = logging.getLogger(__name__)

Sink = Callable[[dict[str, DataFrame]], None]


def archive(
    arrived: DataFrame, lake: str, expected_source: str = fixed.EXPECTED_SOURCE, batch: str | None = None
) -> str:
    """Check what arrived (documents or posting lines) and store all of it; the batch's name."""
    payloads = snap.documents(arrived) if "payload" in arrived.columns else None
    return archive_batch(snap.arrived_postings(arrived, expected_source), payloads, lake, batch)


def newest_snapshot(heads: DataFrame) -> tuple[int, str] | None:
    """``(epoch second obtained, key)`` of the newest, or None; one row reaches the driver."""
    latest = F.max(F.struct(epoch_seconds(F.col("obtained_datetime")).alias("obtained"), "key"))
    found = heads.agg(latest.alias("newest")).first().newest
    return None if found is None else (found.obtained, found.key)


def serve(
    snapshot: Archived,
    gazetteer: DataFrame,
    path: str,
    relational: bool = True,
    sink: Sink | None = None,
    insights: bool = True,
    batch: str | None = None,
) -> None:
    """Clean one archived snapshot and publish its tables and insights.

    The snapshot's postings are rows of the lake, so all steps are the work of many
    tasks. The cleaned documents are written first and read back for the relational
    tables and the insights, so cleaning runs once; what breaks a contract is counted
    on that write. A ``sink`` (such as
    ``warehouse.jdbc_sink``) is given the five relational tables too. All tables are
    written and checked before anything becomes visible.
    """
    postings, run = snapshot.postings, warehouse.new_run()
    spark = postings.sparkSession
    metadata = snapshot_head(spark, snapshot)
    known, most = _small_gazetteer(gazetteer, postings)
    cleaned = clean(postings, known, max_places=most)
    checked = ObservedContracts(cleaned) if relational or sink is not None else None
    warehouse.write_documents(metadata, cleaned if checked is None else checked.documents, path, run)
    documents = warehouse.read_written(spark, path, run, "documents")
    metadata = warehouse.read_written(spark, path, run, "metadata")
    tables = {}
    if checked is not None:
        checked.require(documents)
        tables = warehouse_tables(documents, strict=False)
    if relational:
        warehouse.write_warehouse(tables, path, run)
    if insights:
        write_insights(documents, path, run)
    if sink is not None:
        sink({"metadata": metadata, **tables})
    warehouse.publish(metadata, path, snapshot.head.key, run, batch)


def snapshot_head(spark: SparkSession, snapshot: Archived) -> DataFrame:
    """``(source_name, obtained_datetime)`` of an archived snapshot, one row."""
    second, _, source = snapshot.head.key.partition("_")  # what the key is made of
    return spark.range(1).select(F.lit(source).alias("source_name"), F.timestamp_seconds(F.lit(int(second))).alias("obtained_datetime"))


def _small_gazetteer(gazetteer: DataFrame, postings: DataFrame) -> tuple[DataFrame, int | None]:
    """A gazetteer with its size, cut to the places in use if it is a large one."""
    most = places.measured_places(gazetteer)
    if most is not None:
        return gazetteer, most
    spark, path = postings.sparkSession, new_folder(postings.sparkSession, "places")
    places.places_in_use(gazetteer, extract_place_names(postings)).write.parquet(path)
    used = spark.read.schema(gazetteer.schema).parquet(path)
    return used, places.measured_places(used)


def write_insights(documents: DataFrame, path: str, run: str) -> None:
    """Keep the insights of a run's documents, and the cube they come from, as tables of the same run.

    Readers then scan small results and not the documents; insights with other
    parameters are summed from the stored cube.
    """
    warehouse.write_warehouse({"cube": insight_cube(documents)}, path, run)
    cube = warehouse.read_written(documents.sparkSession, path, run, "cube")
    results = {f"insight_{name}": result for name, result in insights_of_cube(cube, documents).items()}
    warehouse.write_warehouse(results, path, run)


def run_pipeline(
    spark: SparkSession,
    arrived: DataFrame,
    gazetteer: DataFrame,
    path: str,
    lake: str | None = None,
    relational: bool = True,
    expected_source: str = fixed.EXPECTED_SOURCE,
    sink: Sink | None = None,
    insights: bool = True,
    batch: str | None = None,
) -> str | None:
    """Archive what arrived and serve the newest snapshot of it.

    Returns the key now served. A snapshot older than the served one is only
    archived. Of several documents of one key the last that the lake holds is
    served. Without a lake the batch is kept as an intermediate table. A ``batch``
    that was published before is not worked on again. Errors are logged and raised.
    """
    try:
        served = warehouse.served_snapshot(spark, path)
        if batch is not None and served is not None and warehouse.is_published(spark, path, batch):
            return served.key
        lake = lake or new_folder(spark, "arrived")
        stored = archive(arrived, lake, expected_source, batch)
        newest = newest_snapshot(read_heads(spark, lake, stored))
        if newest is None or (served is not None and newest < (served.obtained, served.key)):
            return served and served.key
        key = newest[1]
        serve(load_postings(spark, lake, key), gazetteer, path, relational, sink, insights, batch)
        log.info("serving snapshot %s", key)
        return key
    except Exception:
        log.exception("pipeline run failed")
        raise


def replay(
    spark: SparkSession,
    lake: str,
    key: str,
    gazetteer: DataFrame,
    path: str,
    relational: bool = True,
    insights: bool = True,
) -> None:
    """Serve an archived snapshot again, whatever is served now."""
    serve(load_postings(spark, lake, key), gazetteer, path, relational, insights=insights)
