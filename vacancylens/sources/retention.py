"""Removing what nobody reads any more: old runs of the warehouse, small batches of the lake.

Both are explicit calls. Something is removed only once it has been out of use for
a stated age, so a reader that opened it before can finish. What is to stay is
written and visible before anything is removed; a call that dies half way is
simply called again.
"""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens.schemas import ARCHIVED_HEAD, ARCHIVED_POSTING
from vacancylens.sources import lake, warehouse


def _files(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with the epoch milliseconds of their last change."""
    files, where = _files(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(where)} if files.exists(where) else {}


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def expire_runs(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Remove runs of a warehouse that were out of use for ``older_than`` seconds; their names.

    A run is out of use from the publication of the next one; a run that was never
    published, from the last change of its folders. The served run always stays.
    ``served`` is left with the rows of the runs that stay, in one file.
    """
    now = time.time()
    known = warehouse.published_runs(spark, path).orderBy("published").collect()
    out_of_use = {a.run: b.published / 1e6 for a, b in zip(known[:-1], known[1:], strict=True)}
    serving = known[-1].run if known else None
    tables = [t for t in _listed(spark, path) if t != "served"]
    for table in tables:
        for folder, changed in _listed(spark, f"{path}/{table}").items():
            run = folder.removeprefix("run=")
            if folder != run and run not in {r.run for r in known}:
                out_of_use[run] = max(out_of_use.get(run, 0), changed / 1e3)
    gone = sorted(run for run, since in out_of_use.items() if run != serving and now - since >= older_than)
    if known:
        _compact_served(spark, path, gone)
    for table in tables:
        for run in gone:
            _remove(spark, f"{path}/{table}/run={run}")
    return gone


def _compact_served(spark: SparkSession, path: str, gone: list[str]) -> None:
    """The rows that stay as one more file, then without the files before it.

    In between a row is there twice, which no reader minds: the last one counts.
    """
    before = [f for f in _listed(spark, f"{path}/served") if f.endswith(".parquet")]
    kept = warehouse.published_runs(spark, path).where(~F.col("run").isin(gone)).dropDuplicates(["run", "published"])
    if len(before) > 1 or gone:
        kept.coalesce(1).write.mode("append").parquet(f"{path}/served")
        for file in before:
            _remove(spark, f"{path}/served/{file}")


def compact_lake(spark: SparkSession, path: str, older_than: float, postings_a_file: int = lake.POSTINGS_A_FILE) -> str | None:
    """Merge all batches of a lake into one whose files are sorted by key; its name.

    Every document is there once afterwards. The batches it replaces are out of use
    from then on and removed by a later call, ``older_than`` seconds after the merge.
    """
    batches = {b.removeprefix("batch="): changed / 1e3 for b, changed in _listed(spark, f"{path}/heads").items() if b.startswith("batch=")}
    live = {r.batch for r in lake.read_heads(spark, path).select("batch").distinct().collect()}
    merged = None
    if len(live) > 1:
        merged = f"merged-{uuid.uuid4().hex}"
        _merge(spark, path, merged, postings_a_file)
        live = {merged}
    newest = max((batches[b] for b in live if b in batches), default=None)
    if newest is not None and time.time() - newest >= older_than:
        for batch in set(batches) - live:
            for table in ("heads", "postings", "payloads"):
                _remove(spark, f"{path}/{table}/batch={batch}")
    return merged


def _merge(spark: SparkSession, path: str, batch: str, postings_a_file: int) -> None:
    heads = lake.read_heads(spark, path)
    kept = heads.select(*ARCHIVED_HEAD.names[:3], F.col("n_postings").alias("total"))
    rows = lake._of_live_documents(lake._table(spark, path, "postings", ARCHIVED_POSTING), heads).drop("batch", "total")
    # The number announced stands with each document's first row, whatever row had it before.
    rows = rows.join(kept, ["source_name", "key", "document"])
    ranged = _by_key(rows.where("pos is not null or total = 0"), "pos")
    payloads = _by_key(lake.read_lake(spark, path)) if _listed(spark, f"{path}/payloads") else None
    lake.archive_batch(ranged, payloads, path, batch, postings_a_file)


def _by_key(rows: DataFrame, *then: str) -> DataFrame:
    """Dealt by range, so a document's rows are in as few files as they need, and a large one in several."""
    order = ["key", "document", *then]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)
