"""Rows kept in a state value as Arrow bytes.

One state key holds the rows of many series or devices, and a value holds many rows, so a batch costs a few calls of the state
store for each bucket of keys, not for each key or row.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

PACKED = "rows binary"
NO_NUMBER = -(1 << 63)  # stands for a missing number, which pandas would make a float column of


def pack(rows: pd.DataFrame, shape: pa.Schema) -> tuple[bytes]:
    table = pa.Table.from_pandas(rows, shape, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, shape) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def unpack(values: Iterable[tuple], shape: pa.Schema) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(pa.py_buffer(bytes(value[0]))).read_all() for value in values]
    return pa.concat_tables([shape.empty_table(), *tables]).to_pandas()


def as_text(value: Column, kind: DataType) -> Column:
    """A key column as text, so that missing keys do not change the type of the others."""
    return F.hex(value) if isinstance(kind, BinaryType) else value.cast("string")


def from_text(text: Column, kind: DataType) -> Column:
    return F.unhex(text) if isinstance(kind, BinaryType) else text.cast(kind)


def numbered(value: Column) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(NO_NUMBER))
