"""Served tables: the nested documents and the flat relational tables.

Every run writes to folders of its own, also for a snapshot that is served
already. A row appended to ``served`` then makes the whole set visible at once, so
a job that dies half way, or whose tables break a contract, leaves readers on the
previous set. The row published last is the served one.
"""

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens.fixed_values import DOCUMENT_COLUMNS
from vacancylens.functions.times import epoch_seconds
from vacancylens.operators.contracts import require_rows
from vacancylens.schemas import DOCUMENT, METADATA, SERVED


#: Tables that are written at the same time.
WRITERS = 4


class Served(NamedTuple):
    """The run that readers see."""

    obtained: int  # epoch second of its snapshot
    key: str
    run: str


def new_run() -> str:
    """A name for the folders of one run."""
    return uuid.uuid4().hex


def _folder(path: str, run: str, table: str) -> str:
    return f"{path}/{table}/run={run}"


def read_written(spark: SparkSession, path: str, run: str, table: str) -> DataFrame:
    """A table of one run, published or not."""
    reader = spark.read
    if table in ("documents", "metadata"):
        reader = reader.schema({"documents": DOCUMENT, "metadata": METADATA}[table])
    return reader.parquet(_folder(path, run, table))


def write_documents(metadata: DataFrame, documents: DataFrame, path: str, run: str) -> None:
    documents.select(*DOCUMENT_COLUMNS).write.parquet(_folder(path, run, "documents"))
    metadata.write.parquet(_folder(path, run, "metadata"))


def write_warehouse(tables: dict[str, DataFrame], path: str, run: str) -> None:
    """Write the tables of a run, some at a time: most are small, and their jobs share the cluster."""

    def write(named: tuple[str, DataFrame]) -> None:
        named[1].write.parquet(_folder(path, run, named[0]))

    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, tables.items()))  # raises what a write raised


def publish(metadata: DataFrame, path: str, key: str, run: str, batch: str | None = None) -> None:
    """Make the tables of ``run`` the served ones; ``batch`` is what they were made from.

    One appended row is one file, so readers see all of the switch or none. Its
    number is above those of all rows before it, whatever the clocks say.
    """
    before = _published(metadata.sparkSession, path)
    last = 0 if before is None else before.agg(F.max("published")).first()[0] or 0
    now = max(time.time_ns() // 1000, last + 1)
    names = {"run": run, "published": now, "batch": batch}
    row = metadata.select(F.lit(key).alias("key"), "obtained_datetime", *[F.lit(v).cast(SERVED[n].dataType).alias(n) for n, v in names.items()])
    row.limit(1).write.mode("append").parquet(f"{path}/served")


def _published(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SERVED).parquet(f"{path}/served")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs that were published and are still known, ``(key, obtained_datetime, run, published, batch)``."""
    published = _published(spark, path)
    return spark.createDataFrame([], SERVED) if published is None else published


def served_snapshot(spark: SparkSession, path: str) -> Served | None:
    """The run published last, or None."""
    published = _published(spark, path)
    if published is None:
        return None
    obtained = epoch_seconds(F.col("obtained_datetime")).alias("obtained")
    last = published.agg(F.max(F.struct("published", "run", obtained, "key")).alias("s")).select("s.*").first()
    return None if last.run is None else Served(last.obtained, last.key, last.run)


def is_published(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether some run was made from a batch, so that a repeated one need not be."""
    published = _published(spark, path)
    return published is not None and not published.where(F.col("batch") == batch).isEmpty()


def require_served(spark: SparkSession, path: str) -> Served:
    served = served_snapshot(spark, path)
    if served is None:
        raise RuntimeError(f"nothing is published below {path}")
    return served


def read_served(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the run published last."""
    return read_written(spark, path, require_served(spark, path).run, table)


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(metadata, documents)`` of one and the same run; an empty table is an error."""
    run = require_served(spark, path).run
    metadata, documents = (read_written(spark, path, run, t) for t in ("metadata", "documents"))
    return require_rows(metadata, "metadata"), require_rows(documents, "documents")


def jdbc_sink(url: str, **options: str) -> Callable[[dict[str, DataFrame]], None]:
    """A writer that replaces the tables of a relational database over JDBC.

    It replaces one table after another, so readers of the database may see the
    tables of two runs while it works.
    """

    def write(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            sink = table.write.format("jdbc").mode("overwrite")
            sink.options(url=url, dbtable=name, **options).save()

    return write
