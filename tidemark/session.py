"""Session settings every operator relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC clock, adaptive execution) to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        # Adaptive execution merges small shuffle partitions but never splits the initial ones for a plain shuffle.
        spark.conf.set(INITIAL_PARTITIONS, str(max(200, 4 * context.defaultParallelism)))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benches; a cluster job passes its own session to prepare()."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
