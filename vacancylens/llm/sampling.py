"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def bounded_by_label(
    rows: DataFrame, label: str, quota: int, seed: int = 17, max_labels: int = 1000, most_rows: int | None = None
) -> DataFrame:
    """About ``quota`` rows of each label, all of a label that has fewer.

    A row is in by the hash of its id, so the sample doesn't depend on how the
    rows are laid out, and no label's rows meet in one task. The number of rows
    is ``quota`` for each label in expectation. More than ``max_labels`` different
    labels are an error: no label is left out. With ``most_rows`` the quota is a
    label's part of that, if it is less.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} different values")
    if not counts:
        return rows.limit(0)
    quota = quota if most_rows is None else min(quota, most_rows // len(counts))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col(label) == F.lit(row[label]), F.lit(min(1.0, quota / row["count"]))).otherwise(share)
    return rows.filter(draw < share)
