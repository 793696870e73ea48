"""Snapshot envelopes: reading, checking, unpacking and writing them.

A snapshot arrives in one of two forms. An envelope is one JSON document; files
may hold one document each, or one document per line. Posting lines are a line of
JSON for each posting, with the snapshot's metadata on every line and a line
that announces the number of postings: files of any size are split, so many tasks
read one snapshot. Both become the same rows, one for each posting.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylens import fixed_values as fixed
from vacancylens.functions.times import format_iso, parse_iso, snapshot_key
from vacancylens.schemas import ARCHIVED_POSTING, ENVELOPE, POSTING, POSTING_LINE, RAW_SNAPSHOT


def read_archive(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Envelope texts as ``payload`` with ``modified`` (file time), one row each."""
    return _payloads(spark.read.text(path, wholetext=not lines))


def stream_archive(spark: SparkSession, path: str, lines: bool = False, **options: str) -> DataFrame:
    """The same as a file stream: each new file is delivered once."""
    reader = spark.readStream.format("text").option("wholetext", str(not lines)).options(**options)
    return _payloads(reader.load(path))


def _payloads(text: DataFrame) -> DataFrame:
    return text.where(F.trim("value") != "").select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("path"),
    )


def read_landing(
    spark: SparkSession, path: str, source_name: str = fixed.EXPECTED_SOURCE, lines: bool = False
) -> DataFrame:
    """Raw responses without metadata, wrapped into envelopes.

    The file time is the time obtained. The response stays as it was received.
    """
    return wrap_raw(read_archive(spark, path, lines), F.col("payload"), F.lit(source_name), F.col("modified"))


def stream_landing(
    spark: SparkSession, path: str, source_name: str = fixed.EXPECTED_SOURCE, lines: bool = False, **options: str
) -> DataFrame:
    """The same as a file stream."""
    landed = stream_archive(spark, path, lines, **options)
    return wrap_raw(landed, F.col("payload"), F.lit(source_name), F.col("modified"))


def wrap_raw(df: DataFrame, raw: Column, source_name: Column, obtained: Column) -> DataFrame:
    """Put raw JSON text into an envelope, byte for byte, as column ``payload``."""
    metadata = F.to_json(F.struct(source_name.alias("source_name"), format_iso(obtained).alias("obtained_datetime")))
    return df.withColumn(
        "payload", F.concat(F.lit('{"metadata": '), metadata, F.lit(', "raw_data": '), raw, F.lit("}"))
    )


def read_snapshot(envelopes: DataFrame) -> DataFrame:
    """Parse payloads; a document without its mandatory parts fails the query.

    Adds ``source_name``, ``obtained_datetime``, ``key`` and ``raw_data``. The
    document is parsed in a generator: the checks are filters, and a filter on a
    plain column would be moved below it together with a parse of its own.
    """
    parsed = envelopes.withColumn("_envelope", F.explode(F.array(F.from_json("payload", ENVELOPE))))
    obtained = parse_iso(F.col("_envelope.metadata.obtained_datetime"))
    opened = parsed.select(
        *envelopes.columns,
        F.col("_envelope.metadata.source_name").alias("source_name"),
        obtained.alias("obtained_datetime"),
        snapshot_key(obtained, F.col("_envelope.metadata.source_name")).alias("key"),
        F.col("_envelope.raw_data").alias("raw_data"),
    )
    return (
        opened.transform(must, F.col("source_name").isNotNull(), "envelope has no metadata.source_name")
        .transform(must, F.col("obtained_datetime").isNotNull(), "envelope has no valid metadata.obtained_datetime")
        .transform(must, F.col("raw_data").isNotNull(), "envelope has no raw_data")
    )


def snapshot_heads(envelopes: DataFrame, *others: str) -> DataFrame:
    """``(source_name, obtained_datetime, key)`` and other columns; postings are not parsed."""
    head = F.from_json("payload", T.StructType([ENVELOPE["metadata"]]))
    opened = envelopes.select(*others, head.getField("metadata").alias("m")).select(
        *others, "m.source_name", parse_iso(F.col("m.obtained_datetime")).alias("obtained_datetime")
    )
    return opened.withColumn("key", snapshot_key(F.col("obtained_datetime"), F.col("source_name")))


def must(df: DataFrame, holds: Column, message: str) -> DataFrame:
    """Fail the query on a row where ``holds`` is not true.

    A filter rather than a column, so that pruning cannot remove the check.
    """
    return df.where(F.when(F.coalesce(holds, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message))))


def check_source(snapshots: DataFrame, expected: str = fixed.EXPECTED_SOURCE) -> DataFrame:
    return must(snapshots, F.col("source_name") == expected, f"snapshot does not come from {expected}")


def check_count(snapshots: DataFrame) -> DataFrame:
    announced, found = F.col("raw_data.totalCount"), F.size("raw_data.postings")
    return must(snapshots, announced == found, "totalCount is absent or differs from the number of postings")


def snapshot_metadata(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("source_name", "obtained_datetime")


def _fields(posting: Column) -> list[Column]:
    """The fields of a parsed posting."""
    fields = {field.name: posting.getField(field.name) for field in POSTING}
    for field in POSTING:
        if isinstance(field.dataType, T.StringType):
            fields[field.name] = _text(fields[field.name])
    salary = fields["salary"]
    fields["salary"] = F.when(salary.isNotNull(), salary.withField("type", _text(salary.getField("type"))))
    return [value.alias(name) for name, value in fields.items()]


def snapshot_postings(snapshots: DataFrame) -> DataFrame:
    """One row per posting with its snapshot ``key`` and place ``pos`` in the array."""
    rows = snapshots.select("key", F.posexplode("raw_data.postings").alias("pos", "_posting"))
    return rows.select("key", "pos", *_fields(F.col("_posting")))


def _text(value: Column) -> Column:
    """NULL for a bare NaN, which JSON parsing puts into a text field with quotes."""
    return F.when(value != '"NaN"', value)


def extract(envelopes: DataFrame, expected_source: str = fixed.EXPECTED_SOURCE) -> tuple[DataFrame, DataFrame]:
    """Checked ``(metadata, postings)`` of the given envelopes."""
    checked = read_snapshot(envelopes).transform(check_source, expected_source).transform(check_count)
    return snapshot_metadata(checked), snapshot_postings(checked)


def _document() -> Column:
    """Names a document by its content; several may have one key."""
    return F.substring(F.sha2(F.col("payload"), 256), 1, 32)


def documents(envelopes: DataFrame) -> DataFrame:
    """Envelopes with what names them; postings are not parsed."""
    heads = snapshot_heads(envelopes, "payload", "modified", "path")
    return heads.withColumn("document", _document()).select(*RAW_SNAPSHOT.names)


def document_postings(envelopes: DataFrame, expected_source: str = fixed.EXPECTED_SOURCE) -> DataFrame:
    """Postings of whole documents, checked for structure and source.

    A row for each posting, with its document's head and the number announced; a
    document without postings has a row without ``pos``.
    """
    # Named before it is taken apart, so no posting carries its document along.
    named = envelopes.withColumn("document", _document())
    checked = read_snapshot(named).transform(check_source, expected_source)
    head = ["source_name", "key", "document", "obtained_datetime", "modified", "path", F.col("raw_data.totalCount").alias("total")]
    rows = checked.select(*head, F.posexplode_outer("raw_data.postings").alias("pos", "_posting"))
    return rows.select(*ARCHIVED_POSTING.names[:8], *_fields(F.col("_posting")))


def read_posting_lines(spark: SparkSession, path: str) -> DataFrame:
    """Posting lines as ``line``, with ``modified`` (file time) and ``path``."""
    return _payloads(spark.read.text(path)).withColumnRenamed("payload", "line")


def stream_posting_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same as a file stream."""
    return _payloads(spark.readStream.format("text").options(**options).load(path)).withColumnRenamed("payload", "line")


def line_postings(lines: DataFrame, expected_source: str = fixed.EXPECTED_SOURCE) -> DataFrame:
    """Posting lines as rows like those of :func:`document_postings`.

    A line is ``{"metadata": ..., "pos": 0, "posting": {...}}``; one line of a snapshot
    has ``"totalCount"`` and no posting. Snapshots of one key need ``"document"`` on
    their lines to be told apart.
    """
    parsed = lines.withColumn("_line", F.explode(F.array(F.from_json("line", POSTING_LINE))))
    obtained, source = parse_iso(F.col("_line.metadata.obtained_datetime")), F.col("_line.metadata.source_name")
    key = snapshot_key(obtained, source)
    opened = parsed.select(
        source.alias("source_name"), key.alias("key"), F.coalesce("_line.document", key).alias("document"),
        obtained.alias("obtained_datetime"), "modified", "path", F.col("_line.totalCount").alias("total"),
        "_line.pos", F.col("_line.posting").alias("_posting"),
    )
    checked = (
        opened.transform(must, F.col("source_name").isNotNull(), "posting line has no metadata.source_name")
        .transform(must, F.col("obtained_datetime").isNotNull(), "posting line has no valid metadata.obtained_datetime")
        .transform(must, F.col("pos").isNotNull() == F.col("_posting").isNotNull(), "posting line needs both pos and posting, or none")
        .transform(check_source, expected_source)
    )
    return checked.select(*ARCHIVED_POSTING.names[:8], *_fields(F.col("_posting")))


def arrived_postings(arrived: DataFrame, expected_source: str = fixed.EXPECTED_SOURCE) -> DataFrame:
    """Posting rows of what arrived, in either form."""
    read = line_postings if "line" in arrived.columns else document_postings
    return read(arrived, expected_source)


def to_envelope_json(source_name: Column, obtained: Column, raw_data: Column) -> Column:
    """Serialise one snapshot held in columns; NULL fields are written out."""
    metadata = F.struct(source_name.alias("source_name"), format_iso(obtained).alias("obtained_datetime"))
    return F.to_json(
        F.struct(metadata.alias("metadata"), raw_data.alias("raw_data")), {"ignoreNullFields": "false"}
    )


def posting_url(df: DataFrame, name: str = "page_url") -> DataFrame:
    """Address of the page behind a posting's ``url`` slug."""
    return df.withColumn(name, F.concat(F.lit(fixed.POSTING_PAGE_PREFIX), F.col("url")))


