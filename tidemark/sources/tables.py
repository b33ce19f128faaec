"""Table readers and writers over Spark's file formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import day_key, month_key

# Options that keep text with quotes and line breaks intact in both directions.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None, **options: str
) -> DataFrame:
    """Read any file or table format Spark knows. Text formats need a schema, so that no pass infers one."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs an explicit schema")
    reader = spark.read.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_statistics(spark: SparkSession, path: str) -> DataFrame:
    """A parquet scan that answers MIN, MAX and COUNT from file footers.

    Only the newer reader pushes aggregates down; the setting that picks it is read when the scan is resolved.
    """
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(key, before)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file with its number of characters."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.col("_metadata.file_name").alias("file"), F.length("value").alias("n_chars"))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    codec: str | None = None,
    **options: str,
) -> None:
    """Write or append. Appending adds part files; nothing already stored is rewritten.

    One writer per path: two jobs that commit into one folder at once need a table format with its own commit.
    """
    writer = df.write.format(fmt).mode(mode).options(**(CSV_OPTIONS if fmt == "csv" else {})).options(**options)
    if codec is not None:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_jdbc(df: DataFrame, url: str, name: str, batch_rows: int = 20000, **properties: str) -> None:
    """Append to a database table in batches; the driver jar comes from the session."""
    df.write.mode("append").jdbc(url, name, properties={"batchsize": str(batch_rows), **properties})


def read_jdbc(spark: SparkSession, url: str, subquery: str, **properties: str) -> DataFrame:
    """Read a table or a parenthesised subquery with an alias; the database runs the subquery."""
    return spark.read.jdbc(url, subquery, properties=properties)


def write_noop(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def write_by(
    df: DataFrame, path: str, partition: str, mode: str = "overwrite", sort: Sequence[str] = (), codec: str | None = None
) -> None:
    """Write one directory per partition value.

    The rebalance hint gathers a value into one file when it is small and lets adaptive execution split it over
    tasks when it is not, so a day with a third of all rows is not one task.
    """
    balanced = df.hint("rebalance", partition)
    if sort:
        balanced = balanced.sortWithinPartitions(partition, *sort)
    writer = balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    if codec is not None:
        writer = writer.option("compression", codec)
    writer.parquet(path)


def compact(spark: SparkSession, source: str, target: str, partition: str | None = None, fmt: str = "parquet") -> None:
    """Rewrite many small part files as few; the sizes follow adaptive execution's advisory size."""
    stored = spark.read.format(fmt).load(source)
    if partition is not None:
        write_by(stored, target, partition)
    else:
        stored.hint("rebalance").write.format(fmt).mode("overwrite").save(target)


def create_table(
    spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Create a parquet table with the given schema unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    partitioned = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    placed = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned}{placed}")


UNDATED = "1970-01-01"  # fixed value: the day that rows without a date are filed under


def write_export(
    df: DataFrame, path: str, date_column: str, grain: str = "day", keys: Sequence[str] = (), undated: bool = False
) -> None:
    """Replace the export under ``path``: one directory per day or month.

    With ``keys`` only one row of each key is exported, so replayed events do not repeat. Rows without a date stay out,
    or with ``undated`` go to the directory of 1970-01-01.
    """
    key = {"day": day_key, "month": month_key}[grain]
    rows = df.dropDuplicates(list(keys)) if keys else df
    day = F.coalesce(F.col(date_column), F.lit(UNDATED).cast("date")) if undated else F.col(date_column)
    dated = rows.filter(day.isNotNull()).withColumn("part", key(day))
    dated.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "part"
    ).parquet(path)


def file_count(spark: SparkSession, path: str, *by: str, fmt: str = "parquet") -> DataFrame:
    """Number of non-empty data files behind a table, or behind each value of its partition columns ``by``."""
    files = spark.read.format(fmt).load(path).select(*by, F.col("_metadata.file_path").alias("file"))
    return files.groupBy(*by).agg(F.countDistinct("file").alias("files"))


def storage_report(spark: SparkSession, paths: dict[str, str], base: str) -> DataFrame:
    """Bytes per labelled table and the ratio to the ``base`` label; only file sizes are read."""
    sizes = None
    for label, path in paths.items():
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
            F.lit(label).alias("label"), "length"
        )
        sizes = listed if sizes is None else sizes.unionByName(listed)
    totals = sizes.groupBy("label").agg(F.sum("length").alias("bytes"))
    base_bytes = totals.filter(F.col("label") == base).select("bytes").scalar()
    return totals.withColumn("ratio", F.col("bytes") / base_bytes)
