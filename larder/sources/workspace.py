"""Tables that a job writes, reads back and removes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder, if it is there."""
    files, place = _place(spark, path)
    files.delete(place, True)


class Workspace:
    """A new folder in a file system that all executors share. What is stored there survives lost executors and cuts
    the lineage; ``remove`` and ``close`` delete it."""

    def __init__(self, spark: SparkSession, parent: str):
        self.spark = spark
        self.folder = f"{parent.rstrip('/')}/work-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._stored_at = path
        return table

    def remove(self, table: DataFrame) -> None:
        """Delete a table that ``store`` returned and nothing reads any more."""
        delete(self.spark, table._stored_at)

    def close(self) -> None:
        delete(self.spark, self.folder)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()
