"""Column presence, types and order."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_known(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Only the wanted columns that exist, in the order of the list."""
    return df.select(*[name for name in wanted if name in df.columns])


def ensure_columns(df: DataFrame, columns: dict[str, T.DataType]) -> DataFrame:
    """Add each missing column as a typed NULL."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns, types and order of the schema.

    Values that do not fit the type become NULL, and so do missing columns.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    if list(have.items()) == [(field.name, field.dataType) for field in schema.fields]:
        return df

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(f"`{field.name}`")
        if have[field.name] != field.dataType:
            c = c.try_cast(field.dataType)
        return c.alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def plain_names(df: DataFrame) -> DataFrame:
    """Replace hyphens in column names by underscores."""
    return df.withColumnsRenamed({name: name.replace("-", "_") for name in df.columns if "-" in name})


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns are matched by name and filled with NULL where missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
