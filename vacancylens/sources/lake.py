"""Archived snapshots: postings as rows, raw documents beside them, and a manifest.

A batch is written once, into folders of its own:

- ``postings``: a row for each posting, many documents a file and many files a
  large document, so reading one snapshot is the work of many tasks;
- ``payloads``: the documents as they came, if they came as documents;
- ``heads``: the manifest, a row for each document with its files. It is written
  last, by an aggregate over what was written that also compares the number of
  postings with the number announced. What has no head is not in the lake.

The same batch written again replaces itself, and a document that came in several
batches counts once. Nothing that differs is ever replaced.
"""

import time
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vacancylens.schemas import ARCHIVED_HEAD, ARCHIVED_POSTING, RAW_SNAPSHOT
from vacancylens.sources.snapshots import must

#: A file of postings holds at most so many, a file of documents so many.
POSTINGS_A_FILE, PAYLOADS_A_FILE = 250_000, 1000
#: Which of several documents of one key is the last: the file modified last.
LAST_FIRST = ("modified", "path", "document")
_DOCUMENT = ["source_name", "key", "document"]


class Archived(NamedTuple):
    """One document of the lake."""

    head: Row
    postings: DataFrame


def last_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in LAST_FIRST]


def _folder(path: str, table: str, batch: str) -> str:
    return f"{path}/{table}/batch={batch}"


def archive_batch(
    postings: DataFrame, payloads: DataFrame | None, path: str, batch: str | None = None, postings_a_file: int | None = None
) -> str:
    """Store arrived postings and, if there are any, their documents; the batch's name."""
    spark, batch = postings.sparkSession, batch or uuid.uuid4().hex
    rows = postings.select(*ARCHIVED_POSTING.names)
    rows.write.mode("overwrite").option("maxRecordsPerFile", postings_a_file or POSTINGS_A_FILE).parquet(_folder(path, "postings", batch))
    if payloads is not None:
        documents = payloads.select(*RAW_SNAPSHOT.names)
        documents.write.mode("overwrite").option("maxRecordsPerFile", PAYLOADS_A_FILE).parquet(_folder(path, "payloads", batch))
    heads = _heads(spark, path, batch, payloads is not None)
    heads.write.mode("overwrite").parquet(_folder(path, "heads", batch))
    return batch


def _heads(spark: SparkSession, path: str, batch: str, with_payloads: bool) -> DataFrame:
    """The batch's manifest. A document with too few or too many postings fails it."""
    written = spark.read.schema(ARCHIVED_POSTING).parquet(_folder(path, "postings", batch))
    described = [F.max(c).alias(c) for c in ("obtained_datetime", "modified", "path")]
    file = F.col("_metadata.file_name")
    counted = written.groupBy(*_DOCUMENT).agg(
        *described, F.max("total").alias("total"), F.count("pos").alias("n_postings"), F.array_sort(F.collect_set(file)).alias("files")
    )
    heads = must(counted, F.col("total") == F.col("n_postings"), "totalCount is absent or differs from the number of postings")
    if with_payloads:
        stored = spark.read.schema(RAW_SNAPSHOT).parquet(_folder(path, "payloads", batch))
        held = stored.groupBy(*_DOCUMENT).agg(F.array_sort(F.collect_set(file)).alias("payload_files"))
        heads = heads.join(held, _DOCUMENT, "left")
    else:
        heads = heads.withColumn("payload_files", F.array().cast("array<string>"))
    heads = heads.withColumns({"archived": F.lit(time.time_ns() // 1000), "batch": F.lit(batch)})
    return heads.select(*[F.col(f.name).cast(f.dataType) for f in ARCHIVED_HEAD])


def _all_heads(spark: SparkSession, path: str) -> DataFrame:
    """Heads of all batches; a document archived twice has several."""
    try:
        return spark.read.schema(ARCHIVED_HEAD).option("recursiveFileLookup", "true").parquet(f"{path}/heads")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return spark.createDataFrame([], ARCHIVED_HEAD)
        raise


def read_heads(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """The manifest, a row for each document; of all batches or of one."""
    if batch is not None:
        return spark.read.schema(ARCHIVED_HEAD).parquet(_folder(path, "heads", batch))
    newest = F.row_number().over(Window.partitionBy(*_DOCUMENT).orderBy(F.desc("archived"), "batch"))
    return _all_heads(spark, path).withColumn("_newest", newest).where("_newest = 1").drop("_newest")


def _of_live_documents(table: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of the batch that counts for their document."""
    own = ["batch", *_DOCUMENT]
    return table.join(heads.select(*own), own, "left_semi")


def _table(spark: SparkSession, path: str, table: str, schema: StructType) -> DataFrame:
    """A table of all batches, with the batch of each row."""
    reader = spark.read.schema(StructType([*schema.fields, StructField("batch", StringType())]))
    return reader.option("basePath", f"{path}/{table}").parquet(f"{path}/{table}")


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """All archived documents as they came."""
    return _of_live_documents(_table(spark, path, "payloads", RAW_SNAPSHOT), read_heads(spark, path)).drop("batch")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Postings of all archived documents, with ``key``, ``document`` and ``pos``."""
    stored = _table(spark, path, "postings", ARCHIVED_POSTING).where("pos is not null")
    return _of_live_documents(stored, read_heads(spark, path)).drop("batch")


def _last_head(spark: SparkSession, path: str, key: str) -> Row:
    found = _all_heads(spark, path).where(F.col("key") == key).orderBy(*last_first(), F.desc("archived")).head(1)
    if not found:
        raise KeyError(f"no snapshot is archived under {key}")
    return found[0]


def _rows_of(reader: DataFrame, head: Row) -> DataFrame:
    return reader.where((F.col("key") == head.key) & (F.col("document") == head.document))


def load_archived(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The last document stored under ``key`` as it came, or ``KeyError``.

    The manifest names the file, so no other is listed or opened.
    """
    head = _last_head(spark, path, key)
    if not head.payload_files:
        raise KeyError(f"what is archived under {key} came as posting lines")
    files = [f"{_folder(path, 'payloads', head.batch)}/{f}" for f in head.payload_files]
    return _rows_of(spark.read.schema(RAW_SNAPSHOT).parquet(*files), head)


def load_postings(spark: SparkSession, path: str, key: str) -> Archived:
    """The last document stored under ``key``, its postings read by as many tasks as its files need."""
    head = _last_head(spark, path, key)
    files = [f"{_folder(path, 'postings', head.batch)}/{f}" for f in head.files]
    rows = _rows_of(spark.read.schema(ARCHIVED_POSTING).parquet(*files), head)
    return Archived(head, rows.where("pos is not null"))
