"""Named queries over the driver's tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lineage import new_folder
from tidemark.session import prepare

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return plain_dates(build(spark, sf_dir))

        REGISTRY[name] = Query(name, run, sql)
        return build

    return add


def plain_dates(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that every client compares them alike."""
    shown = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_BUILT: dict[tuple, str] = {}


def state_of(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """What tells a table's content apart without reading it: its files with their sizes and times."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, found = store.listFiles(root, True), []
    while listed.hasNext():
        f = listed.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def forget_built() -> None:
    """Build derived tables anew at their next use."""
    _BUILT.clear()


def built_once(spark: SparkSession, sf_dir: str, source: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from table ``source``, written to the shared folder once for each state of its files."""
    key = (spark.sparkContext.applicationId, label, state_of(spark, sf_dir, source))
    if key not in _BUILT:
        path = new_folder(spark, label)
        write(path)
        _BUILT[key] = path
    return _BUILT[key]
