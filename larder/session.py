"""Session settings shared by every job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps dates stable. ANSI is Spark's default: bad text must be handled, not silently nulled.
# Adaptive execution sizes reduce partitions, turns a join into a broadcast only when the measured
# side is small, and splits a join partition that one hot key has made too large.
# Window and aggregate need rows spread by all of their keys: a partitioning left over from a join on one
# of them would put that key's rows into one task.
# The JVM does not compile methods beyond 8000 bytes of bytecode, so a wide projection fused into one
# larger method would run interpreted; with the limit its steps are generated separately.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(
    app: str = "larder",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or fetch a session with the settings above.

    ``shuffle_partitions`` is the number of reduce partitions before adaptive coalescing. Leave it
    unset to keep the cluster's own value; on a large cluster it should be 2-3 times the cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
