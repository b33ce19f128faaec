"""Raw session files: one file is one session, its name is the session id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import decode_single_byte, last_path_part
from tidemark.lineage import written
from tidemark.operators.joins import join_on


def decode_sessions(files: DataFrame, charset: str = "cp1251") -> DataFrame:
    """``path, content`` bytes (batch or stream) to ``session_id, path, content`` text."""
    return files.select(
        last_path_part(F.col("path")).alias("session_id"),
        "path",
        decode_single_byte(F.col("content"), charset).alias("content"),
    )


def list_sessions(spark: SparkSession, path: str) -> DataFrame:
    """File names and sizes only; the unread content column is pruned from the scan.

    Empty files have no events and the file source shows no row for them.
    """
    return _files(spark, path).select("path", "length", "modificationTime")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def read_sessions(spark: SparkSession, path: str, charset: str = "cp1251") -> DataFrame:
    """Every session file under ``path``, decoded."""
    return decode_sessions(_files(spark, path), charset)


def read_session_lines(spark: SparkSession, path: str, charset: str = "cp1251") -> DataFrame:
    """``session_id, path, line_base, content``: a row for each line of every file under ``path``, of any size.

    Files are read in splits of ``spark.sql.files.maxPartitionBytes``, so a large file is the work of many tasks. A split's rows keep
    their order and know the byte at which the split begins; the lines of a file's earlier splits, added up, give a
    line the number that it has in the whole text. Only the table of splits is grouped by file. Lines are stored once.
    A single line still has to fit a row. Compressed files are not split.
    """
    source = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # as the whole-file reader shows it
    text = decode_single_byte(F.col("value").cast("binary"), charset)
    pieces = source.select(
        F.regexp_replace(where, "^file:/+", "file:/").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.explode(F.split(text, "\f")).alias("content"),  # a form feed ends a line too
    )
    lines = written(pieces.withColumn("place", F.monotonically_increasing_id()), "session-lines")
    splits = lines.groupBy("path", "split_start").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    numbered = join_on(lines, written(bases, "session-splits"), ["path", "split_start"], strategy="broadcast")
    return numbered.select(
        last_path_part(F.col("path")).alias("session_id"),
        "path",
        (F.col("base") + F.col("place") - F.col("first")).alias("line_base"),
        "content",
    )
