"""What the operators share: column choice, folds, intermediate tables, plain tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lineage import written

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id as ``doc_id`` and the text, null read as empty; other columns cannot clash."""
    return df.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder that all executors share and read back."""
    return written(df, label)


def shuffled(df: DataFrame) -> DataFrame:
    """One side of a join, marked so that both sides are shuffled, whatever Spark takes their sizes to be.

    For sides that grow with the input: Spark goes by the size of files, which are packed, and does not see how many rows Python makes
    of one. What it broadcasts by such an estimate is held by the driver, unpacked.
    """
    return df.hint("merge")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[tuple[list, list[str]]]:
    """Slices of (ids, texts) of a batch stream with columns doc_id and text."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part.column("doc_id").to_pylist(), part.column("text").to_pylist()


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def ragged_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for each i; no slice is empty."""
    return np.add.reduceat(values, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)
