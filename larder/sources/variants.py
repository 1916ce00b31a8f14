"""JSON documents of unlike shapes under one contract, without a declared layout.

A document is parsed once into a variant. The contract names, for each of its columns, the paths where a value may stand; the first path
that holds a value of the column's type wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = "document"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per line that is not blank: ``document``, a variant, ``file``, and ``unreadable``, the line if it is not JSON, else NULL.

    No layout is inferred, so the files are read once. A document that holds the same name twice in one object is unreadable, too.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(F.try_parse_json("value").alias(DOCUMENT), F.col("_metadata.file_path").alias("file"), "value")
    return parsed.select(DOCUMENT, "file", F.when(F.col(DOCUMENT).isNull(), F.col("value")).alias("unreadable"))


def first_of(document: Column, paths: Sequence[str], kind: T.DataType) -> Column:
    """The value at the first path that has one. A path that is missing, holds null, or holds what cannot become ``kind`` is passed over."""
    return F.coalesce(*[F.try_variant_get(document, path, kind.simpleString()) for path in paths])


def as_contract(documents: DataFrame, schema: T.StructType, paths: Mapping[str, Sequence[str]]) -> DataFrame:
    """The columns of the schema from the readable documents, beside their ``file``. Without paths a column is sought under its own name.

    Paths are written as ``$.party.names[0]``, with names that need it as ``$['last name']``.
    """
    unknown = sorted(set(paths) - set(schema.names))
    if unknown:
        raise ValueError(f"paths for columns that the contract lacks: {unknown}")
    found = [
        first_of(F.col(DOCUMENT), paths.get(field.name, [f"$['{field.name}']"]), field.dataType).alias(field.name)
        for field in schema.fields
    ]
    return documents.where(F.col(DOCUMENT).isNotNull()).select(*found, "file")


def document_paths(documents: DataFrame) -> DataFrame:
    """Top-level names, the variant type of what stands there, decimals without their width, and the number of documents: what a new source sends."""
    text = F.to_json(F.col(DOCUMENT))
    names = documents.where(F.col(DOCUMENT).isNotNull()).select(DOCUMENT, F.explode(F.json_object_keys(text)).alias("name"))
    kind = F.schema_of_variant(F.try_variant_get(DOCUMENT, F.concat(F.lit("$['"), F.col("name"), F.lit("']")), "variant"))
    kind = F.regexp_replace(kind, r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    return names.groupBy("name", kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))
