"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SCOPE: ContextVar[list[str] | None] = ContextVar("staged_folders", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in a single-JVM session without that setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created until something is written there."""
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


@contextmanager
def staged(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside when the block ends. Results must be written elsewhere by then."""
    folders: list[str] = []
    token = _SCOPE.set(folders)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in folders:
            drop_folder(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads the table instead of re-running everything above it,
    and operators that read their input twice pay for a pruned column scan instead of a second run.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unwritten(df: DataFrame, label: str) -> DataFrame:
    """Keep the plan lazy; for inputs small enough that recomputing is cheaper than a write."""
    return df
