"""The fact in files by year and in buckets by product, so that reports read the years they ask for and product joins need no exchange."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import DIM_PRODUCT, FACT_NUTRITION_SNAPSHOT
from larder.sources.workspace import exists

YEAR, PRODUCT = "year", "product_sk"
FACT, DIMENSION = "fact_nutrition_snapshot", "dim_product"


@dataclass(frozen=True)
class LaidOut:
    """Fact and products under ``folder``. ``buckets`` is fixed when it is written; choose it so that a bucket of a year is some hundred MB.

    The buckets are known to the catalogue, not to the files: ``open`` names the files to the session that reads them.
    """

    folder: str
    buckets: int = 256

    def write(self, fact: DataFrame, product: DataFrame) -> None:
        """Rows of the fact without a date are left out. A task writes whole buckets of a year, so there are at most ``buckets`` files a year."""
        dated = fact.where(F.col("time_sk").isNotNull()).withColumn(YEAR, F.floor(F.col("time_sk") / 10000).cast("int"))
        for name, rows, years in ((FACT, dated, [YEAR]), (DIMENSION, product, [])):
            if exists(rows.sparkSession, self._place(name)):
                raise ValueError(f"{self._place(name)} exists")
            table = self._new_name(name)
            # Each bucket of a year is in one task, and few of them are, so that a task does not sort whole buckets. The writer sorts.
            tasks = max(self.buckets, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if years else self.buckets
            bucket = F.pmod(F.hash(PRODUCT), F.lit(self.buckets)) if years else F.col(PRODUCT)
            dealt = rows.repartition(tasks, bucket, *years)
            writer = dealt.write.format("parquet").option("path", self._place(name)).bucketBy(self.buckets, PRODUCT).sortBy(PRODUCT)
            (writer.partitionBy(*years) if years else writer).saveAsTable(table)
            rows.sparkSession.sql(f"DROP TABLE {table}")  # the files stay

    def open(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Fact, with its ``year``, and products."""
        return {
            FACT: self._open(spark, FACT, [*FACT_NUTRITION_SNAPSHOT.fields], f"{YEAR} int"),
            DIMENSION: self._open(spark, DIMENSION, DIM_PRODUCT.fields, None),
        }

    def _open(self, spark: SparkSession, name: str, fields, partition: str | None) -> DataFrame:
        table = self._new_name(name)
        columns = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ([partition] if partition else []))
        by = f"PARTITIONED BY ({YEAR})" if partition else ""
        place = self._place(name).replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet {by} "
            f"CLUSTERED BY ({PRODUCT}) SORTED BY ({PRODUCT}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        if partition:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        return spark.table(table)

    def _place(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    @staticmethod
    def _new_name(name: str) -> str:
        return f"{name}_{uuid.uuid4().hex}"


def dated(fact: DataFrame, time: DataFrame) -> DataFrame:
    """Rows of a laid out fact on the days of ``time``, without their year.

    The join is on the year, too: what ``time`` is filtered by, be it weeks or weekdays, decides while the query runs which years are read.
    """
    days = time.select("time_sk", YEAR)
    return fact.join(days, ["time_sk", YEAR], "left_semi").drop(YEAR)
