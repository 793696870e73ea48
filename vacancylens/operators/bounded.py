"""Broadcasting only what has a proven bound."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table proven to have at most this many (narrow) rows may be broadcast.
BROADCAST_ROWS = 10_000


def broadcast_bounded(df: DataFrame, max_rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it cannot exceed ``max_rows`` rows and that is few.

    Otherwise the join is left to Spark, which broadcasts by measured size and
    falls back to a shuffled, skew-splitting join.
    """
    if max_rows is not None and max_rows <= limit:
        return F.broadcast(df)
    return df


def measured_rows(df: DataFrame, limit: int) -> int | None:
    """The number of rows if it is at most ``limit``, else None; stops counting there."""
    rows = df.limit(limit + 1).count()
    return rows if rows <= limit else None
