"""Python UDF twins of native columns, kept only to compare speed and results."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.udf(StringType())
def bid_category_rowwise(price):
    if price is None:
        return "unknown"
    if price == 0:
        return "zero"
    return "low" if price < 2.0 else "medium" if price < 5.0 else "high"


@F.pandas_udf(StringType())
def bid_category_arrow(price: pd.Series) -> pd.Series:
    named = pd.Series("high", index=price.index, dtype=object)
    named[price < 5.0] = "medium"
    named[price < 2.0] = "low"
    named[price == 0] = "zero"
    named[price.isna()] = "unknown"
    return named


@F.udf(DoubleType())
def normalized_price_rowwise(price):
    return (0.0 if price is None else price) / 10.0


@F.pandas_udf(DoubleType())
def normalized_price_arrow(price: pd.Series) -> pd.Series:
    return price.fillna(0.0) / 10.0
