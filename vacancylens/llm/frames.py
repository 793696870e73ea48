"""Helpers shared by the operators: stored tables, checked broadcasts, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylens.llm.arrays import CHUNK, Texts, texts
from vacancylens.session import new_folder, ship_package

#: A table of at most so many rows of a few numbers each may be broadcast
#: (some 50 MB); above it Spark joins by shuffling.
BROADCAST_ROWS = 500_000


#: Batches for Python hold a chunk of text, not as many rows as there are.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready_for_python(spark: SparkSession, batch_bytes: int = CHUNK) -> None:
    """Send the package along, and bound batches by their bytes in this session."""
    ship_package(spark)
    spark.conf.set(_BATCH_BYTES, str(batch_bytes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def split_off_text(docs: DataFrame, text_col: str) -> DataFrame:
    """``_rest`` (all other columns as one struct, by place) and ``_text``."""
    rest = [F.col(_quoted(c)).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_col]
    return docs.select(F.struct(*rest, F.lit(0).alias("end")).alias("_rest"), F.col(_quoted(text_col)).alias("_text"))


def joined_with_text(columns: list[str], text_col: str) -> list[Column]:
    """The columns that :func:`split_off_text` took apart."""
    return [
        (F.col("_text") if c == text_col else F.col("_rest").getField(f"c{k}")).alias(c) for k, c in enumerate(columns)
    ]


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows of some ids (a table of one column)."""
    ids = stored(ids.toDF("_gone").distinct(), "gone")
    return docs.join(small_side(ids, ids.count()), docs[_quoted(id_col)] == ids["_gone"], "left_anti")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def over_texts(
    df: DataFrame,
    function: Callable[[Texts, pa.RecordBatch], dict | Iterator[dict]],
    schema: str | StructType,
    column: str = "text",
    init: Callable[[], None] | None = None,
) -> DataFrame:
    """Apply a function to chunks of rows with their texts as byte arrays.

    The function gets the chunk and the rows it covers, and returns (or
    yields) columns for ``schema``. Memory is bounded by the chunk.
    """
    ready_for_python(df.sparkSession)
    names = [f.name for f in _fields(df.sparkSession, schema)]
    types = [_arrow(f) for f in _fields(df.sparkSession, schema)]
    out = pa.schema(list(zip(names, types, strict=True)))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if init is not None:
            init()
        for batch in stream:
            for chunk in texts(batch.column(batch.schema.get_field_index(column))):
                made = function(chunk, batch.slice(chunk.lo, len(chunk)))
                for columns in [made] if isinstance(made, dict) else made:
                    arrays = [_array(columns[n], t) for n, t in zip(names, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(batches, schema)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, kind)


def _fields(spark: SparkSession, schema: str | StructType) -> list:
    return (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields


def _arrow(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays of different lengths as one Arrow list column."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def over_groups(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], dict], schema: str, partitions: int | None = None
) -> DataFrame:
    """Apply a function to the rows of each key, for groups that are bounded by construction.

    Rows are dealt by the keys and sorted in each task, so groups follow one
    another in Arrow batches, and only the group at hand is held.
    """
    ready_for_python(df.sparkSession)
    names = [f.name for f in _fields(df.sparkSession, schema)]
    types = [_arrow(f) for f in _fields(df.sparkSession, schema)]
    out = pa.schema(list(zip(names, types, strict=True)))

    def finish(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = function(pa.Table.from_batches(rows))
        return pa.RecordBatch.from_arrays([_array(columns[n], t) for n, t in zip(names, types, strict=True)], schema=out)

    def groups(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in stream:
            if not len(batch):
                continue
            columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            new = np.zeros(len(batch), bool)
            for c in columns:
                values = c.to_numpy(zero_copy_only=False)
                new[1:] |= values[1:] != values[:-1]
            first = [c[0].as_py() for c in columns]
            new[0] = last is not None and first != last
            lo = 0
            for cut in [*np.flatnonzero(new).tolist(), None]:
                if cut is None:
                    break
                if cut > lo:
                    held.append(batch.slice(lo, cut - lo))
                if held:
                    yield finish(held)
                held, lo = [], cut
            held.append(batch.slice(lo))
            last = [c[len(batch) - 1].as_py() for c in columns]
        if held:
            yield finish(held)

    dealt = df.repartition(*keys) if partitions is None else df.repartition(partitions, *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(groups, schema)
