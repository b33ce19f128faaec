"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int = 5000, glob: str | None = None
) -> DataFrame:
    """New files under ``path``, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, schema: StructType, max_files: int = 5000) -> DataFrame:
    """A parquet table as a stream: a folder of part files, or one file. The file source wants a folder, so a single file
    is picked out of its own."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if root.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(root).isDirectory():
        return stream_files(spark, path, schema, max_files=max_files)
    return stream_files(spark, root.getParent().toString(), schema, max_files=max_files, glob=root.getName())


def stream_session_files(spark: SparkSession, path: str, max_files: int = 5000) -> DataFrame:
    """New raw session files as bytes."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", "true").load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A message topic as ``key, value, timestamp``. Needs the connector package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    loaded = reader.options(**options).load()
    return loaded.selectExpr("cast(key AS string) AS key", "cast(value AS string) AS value", "timestamp")
