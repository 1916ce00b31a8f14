"""Tables that an operator writes and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.catalogue.scratch import scratch_folder


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder of the cluster and read it from there: a lost executor costs
    nothing that was written, and readers need not compute it again."""
    path = f"{scratch_folder(df.sparkSession)}-{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
