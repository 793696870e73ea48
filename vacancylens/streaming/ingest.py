"""Incremental ingestion: every new snapshot file is processed once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vacancylens import fixed_values as fixed
from vacancylens.plans.pipeline import run_pipeline
from vacancylens.sources.snapshots import stream_archive, stream_landing, stream_posting_lines


def ingest_new_snapshots(
    spark: SparkSession,
    landing: str,
    gazetteer: DataFrame,
    path: str,
    lake: str,
    checkpoint: str,
    lines: bool = False,
    relational: bool = True,
    expected_source: str = fixed.EXPECTED_SOURCE,
    raw: bool = False,
    insights: bool = True,
    posting_lines: bool = False,
    **options: str,
) -> StreamingQuery:
    """Start a query over the files that arrived since the last call, then stop.

    Each micro-batch archives its snapshots and serves the newest one unless a
    newer one is served already. The checkpoint remembers the files. A batch is named
    by the stream and its number: repeated after a failure it replaces what it
    archived, and it is not published twice. With ``raw`` the files are bare responses
    of ``expected_source`` and not envelopes, with ``posting_lines`` lines of postings
    (a snapshot's lines must arrive in one batch). Source options such as
    ``maxFilesPerTrigger`` bound a batch.
    """
    if posting_lines:
        arriving = stream_posting_lines(spark, landing, **options)
    elif raw:
        arriving = stream_landing(spark, landing, expected_source, lines, **options)
    else:
        arriving = stream_archive(spark, landing, lines, **options)

    def process(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        name = f"{_stream_id(session, checkpoint)}-{number}"
        run_pipeline(session, batch, gazetteer, path, lake, relational, expected_source, insights=insights, batch=name)

    return (
        arriving.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name Spark gave the stream when its checkpoint was made."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
