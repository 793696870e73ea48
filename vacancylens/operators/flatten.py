"""Nested documents to flat columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Structs become columns named by their path; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select(
        *[F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path)) for path in leaves(df.schema, ())]
    )
