"""Bucketed running aggregates equal plain windows, whatever the bucket size and however hot the key."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.scan import Carry, Split, by_time, rolling_counts, running


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(1500):
        key = None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
        data.append((i, key, rng.randrange(600), rng.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id bigint, key string, t bigint, tag string").cache()


@pytest.mark.parametrize("grain", [1, 7, 10, 100, 10_000])
def test_running_equals_window(rows, grain):
    tagged = F.when(F.col("tag") == "a", F.struct("t", "id", "tag"))
    carries = [
        Carry("n", "sum", F.lit(1).cast("bigint")),
        Carry("last_a", "max", tagged),
        Carry("before_a", "max", tagged, "before"),
        Carry("first_b", "min", F.when(F.col("tag") == "b", F.col("id"))),
    ]
    got = running(rows, ["key"], ["t", "id"], carries, by_time(F.col("t"), grain))
    want = running(rows, ["key"], ["t", "id"], carries, None)
    columns = ["id", "n", "last_a", "before_a", "first_b"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())


@pytest.mark.parametrize("grain", [3, 50])
def test_peers_see_each_other(rows, grain):
    carry = Carry("seen", "sum", F.lit(1).cast("bigint"), "peers")
    got = running(rows, ["key"], ["t"], [carry], by_time(F.col("t"), grain))
    frame = Window.partitionBy("key").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("seen", F.count("*").over(frame))
    assert sorted(got.select("id", "seen").collect()) == sorted(want.select("id", "seen").collect())


@pytest.mark.parametrize("width,grain", [(10, 3), (50, 7), (5, 100), (0, 10), (20, 5)])
def test_rolling_counts_equal_range_window(rows, width, grain):
    got = rolling_counts(rows, ["key"], "t", {"a": F.col("tag") == "a", "b": F.col("tag") == "b"}, width, grain)
    frame = Window.partitionBy("key").orderBy("t").rangeBetween(-width, 0)
    want = rows.withColumns(
        {name: F.count(F.when(F.col("tag") == name, 1)).over(frame) for name in ("a", "b")}
    )
    assert sorted(got.select("id", "a", "b").collect()) == sorted(want.select("id", "a", "b").collect())


def test_no_exchange_on_the_bare_key_for_rows(rows):
    """Rows are shuffled by (key, bucket); only the one-row-per-bucket totals go by key."""
    got = running(rows, ["key"], ["t"], [Carry("n", "sum", F.lit(1))], Split(F.floor(F.col("t") / 10)))
    plan = plan_of(got).split("== Physical Plan ==")[1]
    top = plan[: plan.index("Union")]
    assert "hashpartitioning(key" in top and "__bucket" in top.split("hashpartitioning(")[1].split(")")[0]
