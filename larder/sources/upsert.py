"""A stored table that takes in new versions of its rows.

Rows are spread over a fixed number of folders by a hash of their key. An upsert reads and rewrites the folders with news only. The
merged rows are written beside the table first; once they are complete, the folders of the table are replaced. If the job dies
in between, the next call finds the complete rows and replaces the folders again, which gives the same table, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.append import keys_present
from larder.operators.dedup import keep_latest
from larder.sources.workspace import delete, exists

PART = "part"
_STORED, _HASH = "__stored", "__hash"


@dataclass(frozen=True)
class UpsertResult:
    """Keys that are new, keys with a newer row, and folders that were written."""

    inserted: int
    updated: int
    rewritten: int


@dataclass(frozen=True)
class KeyedTable:
    """Parquet table with one row per key. One writer at a time; while folders are replaced, readers may see some of the old ones.

    ``parts`` is fixed when the table is created: choose it so that a folder is some hundred MB.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    parts: int = 256

    @property
    def pending(self) -> str:
        return f"{self.path.rstrip('/')}__pending"

    def read(self, spark: SparkSession) -> DataFrame:
        return self._folders(spark).select(*self.schema.names)

    def upsert(
        self, new: DataFrame, newest: Column | None = None, tie_breakers: Sequence[str] = ()
    ) -> UpsertResult:
        """Take in the rows of ``new``: the newest row of each key stays, and of equally new ones that with the larger tie breakers, then
        that with the larger hash. Rows with a NULL in the key are left out. Taking in the same rows again writes nothing."""
        spark = new.sparkSession
        self.recover(spark)
        rows = new.where(keys_present(self.keys)).select(*self.schema.names, self._part().alias(PART))
        rows = rows.withColumn(_STORED, F.lit(0))
        # At most ``parts`` numbers.
        touched = [r[PART] for r in rows.select(PART).distinct().collect()]
        stored = self._folders(spark).where(F.col(PART).isin(touched)).withColumn(_STORED, F.lit(1))
        both = rows.unionByName(stored).withColumn(_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in self.schema.names]))
        # What is stored wins against a copy of itself.
        merged = keep_latest(both, [*self.keys, PART], newest, [*tie_breakers, _HASH, _STORED])
        known = stored.select(*self.keys, PART, F.lit(True).alias("__known"))
        merged = merged.drop(_HASH).join(known, [*self.keys, PART], "left")
        merged.write.partitionBy(PART).parquet(self.pending)
        return self._apply(spark)

    def recover(self, spark: SparkSession) -> None:
        """Finish an upsert that died between its two steps; drop one that died in the first."""
        if exists(spark, f"{self.pending}/_SUCCESS"):
            self._apply(spark)
        delete(spark, self.pending)

    def _apply(self, spark: SparkSession) -> UpsertResult:
        layout = T.StructType(
            [*self.schema.fields, T.StructField(_STORED, T.IntegerType()), T.StructField("__known", T.BooleanType()), T.StructField(PART, T.IntegerType())]
        )
        merged = spark.read.schema(layout).parquet(self.pending)
        news = merged.where(F.col(_STORED) == 0)
        counts = news.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.count("__known").alias("known")).collect()
        if counts:
            rows = merged.where(F.col(PART).isin([r[PART] for r in counts])).select(*self.schema.names, PART)
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PART).parquet(self.path)
        delete(spark, self.pending)
        updated = sum(r["known"] for r in counts)
        return UpsertResult(sum(r["n"] for r in counts) - updated, updated, len(counts))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in self.keys]), F.lit(self.parts)).cast("int")

    def _folders(self, spark: SparkSession) -> DataFrame:
        layout = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        if not exists(spark, self.path):
            return spark.createDataFrame([], layout)
        return spark.read.schema(layout).parquet(self.path)
