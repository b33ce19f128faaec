"""Views of the driver's tables in the shapes the operators work on.

Each view is a narrow projection (no windows, no joins to rows of the same key), so a hot user, session or
publisher in the table stays spread over the input splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_us


def small_number() -> Column:
    """The integer k inside events.props."""
    return F.get_json_object("props", "$.k").cast("int")


def _text(*parts: str | Column) -> Column:
    """Parts joined to one text; null when any part is null."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts])


# ---------------------------------------------------------------- session logs

BLOCK = 8  # line numbers reserved for one event


def session_id() -> Column:
    week = F.date_format(F.date_trunc("week", F.col("ts")), "yyyyMMdd")
    return F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), week)


def _log_time(ts: Column) -> Column:
    return F.date_format(ts, "dd.MM.yyyy_HH:mm:ss")


def event_blocks(events: DataFrame) -> DataFrame:
    """One text chunk of log lines per event: ``session_id, line_base, content``."""
    k = F.col("k")
    small = (k % 7).cast("string")
    shifted = F.col("ts") + F.expr("INTERVAL 3 HOURS")
    when = F.when(
        F.col("event_id") % 7 == 0,
        F.concat(F.date_format(shifted, "EEE,_d_MMM_yyyy_HH:mm:ss"), F.lit("_+0300")),
    ).otherwise(_log_time(F.col("ts")))
    query = _text("QS ", F.col("stamp"), " {q", k % 20, "}")
    answer = _text(small, " LAW_", k, " LAW_", (k + 1) % 100)
    card_id = F.when(k % 2 == 0, small).otherwise(F.concat(F.lit("-"), small))
    card = _text(
        "CARD_SEARCH_START ", F.col("stamp"), "\n$", k, " v", k, "\n$", k + 1, "  w  x \nCARD_SEARCH_END \n",
        card_id, " ACC_", k % 10, " ACC_", k % 10,
    )
    open_id = F.when(k % 3 == 0, F.concat(F.lit("-"), small)).otherwise(small)
    stray = (
        F.when(k % 4 == 0, F.lit("CARD_SEARCH_END"))
        .when(k % 4 == 1, F.lit("QS 99.99.2024_10:00:00 {x}"))
        .when(k % 4 == 2, _text("junk ", k))
        .otherwise(_text("$", k, " stray"))
    )
    kind = F.col("event_type")
    content = (
        F.when((kind == "signup") & (F.col("event_id") % 11 == 0), query)
        .when(kind == "signup", _text(query, "\n", answer))
        .when(kind == "error", card)
        .when(kind == "view", _text("DOC_OPEN ", F.col("stamp"), " ", open_id, " LAW_", k))
        .when(kind == "click", _text("DOC_OPEN  ", small, " LAW_", k))
        .otherwise(stray)
    )
    keyed = events.withColumns({"k": small_number(), "stamp": when})
    return keyed.select(
        session_id().alias("session_id"),
        (F.col("event_id") * BLOCK).alias("line_base"),
        content.alias("content"),
    )


def session_chunks(events: DataFrame) -> DataFrame:
    """Session logs as chunks: a start line, one block per event, an end line. A session is a user's week."""
    bounds = events.groupBy(session_id().alias("session_id")).agg(
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    edges = bounds.select(
        "session_id",
        F.inline(
            F.array(
                F.struct(
                    (F.col("first_id") * BLOCK - 1).alias("line_base"),
                    F.concat(F.lit("SESSION_START "), _log_time(F.col("first_ts"))).alias("content"),
                ),
                F.struct(
                    (F.col("last_id") * BLOCK + BLOCK - 1).alias("line_base"),
                    F.concat(F.lit("SESSION_END "), _log_time(F.col("last_ts"))).alias("content"),
                ),
            )
        ),
    )
    # Text is made and read by as many tasks as there are cores, however few row groups the table is stored in.
    spread = events.repartition("event_id", "user_id", "ts")
    return event_blocks(spread).unionByName(edges)


# ---------------------------------------------------------------- ad tape


def ad_tape(events: DataFrame) -> DataFrame:
    """view, click, purchase as impression, click, conversion; every fifth device id is missing."""
    k = F.col("k")
    device = F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("d"), F.col("user_id").cast("string")))
    return (
        events.filter(F.col("event_type").isin("view", "click", "purchase"))
        .withColumn("k", small_number())
        .select(
            "event_id",
            device.alias("raw_device_id"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
            F.lit(None).cast("string").alias("cookie"),
            F.col("ts"),
            epoch_us(F.col("ts")).alias("ts_us"),
            F.when(F.col("event_type") == "view", "impression")
            .when(F.col("event_type") == "click", "click")
            .otherwise("conversion")
            .alias("event_type"),
            (k % 4).alias("ad_id"),
            (k % 2).alias("campaign_id"),
            F.when(F.col("event_type") == "view", F.col("value")).otherwise(F.lit(0.0)).alias("spend"),
        )
    )


# ---------------------------------------------------------------- impressions


def impressions(lineitem: DataFrame) -> DataFrame:
    agent = (
        F.when(F.col("l_partkey") % 4 == 0, "Mozilla/5.0 (iPhone)")
        .when(F.col("l_partkey") % 4 == 1, "Mozilla/5.0 (Linux; Android 13)")
        .when(F.col("l_partkey") % 4 == 2, "Mozilla/5.0 (X11; Linux)")
    )
    address = (
        F.when(F.col("l_suppkey") % 3 == 0, "192.168.0.1")
        .when(F.col("l_suppkey") % 3 == 1, "10.0.0.1")
        .otherwise("8.8.8.8")
    )
    return lineitem.select(
        F.concat_ws("_", F.lit("tx"), "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.concat(F.lit("pub_"), F.col("l_suppkey").cast("string")).alias("publisher_id"),
        (F.col("l_partkey") % 25).cast("int").alias("geo_id"),
        F.when(F.col("l_linenumber") < 7, F.round(F.col("l_discount") * 100, 2)).alias("bid_price"),
        epoch_us(F.col("l_shipdate")).alias("timestamp"),
        agent.alias("user_agent"),
        address.alias("ip_address"),
        _text('{"floor_price":', F.col("l_linenumber"), ',"ad_size":"300x250"}').alias("bid_request"),
        (F.col("l_extendedprice") / 1000).alias("price"),
    )


def geo_dictionary(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("int").alias("geo_id"), F.col("n_name").alias("country_code"))


def publisher_categories(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.concat(F.lit("pub_"), F.col("s_suppkey").cast("string")).alias("publisher_id"),
        F.concat(F.lit("cat_"), F.col("s_nationkey").cast("string")).alias("category"),
    )


# ---------------------------------------------------------------- text corpus


def corpus(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("prompt_id"),
        F.col("text").alias("prompt"),
        F.col("source").alias("category"),
        F.col("lang").alias("prompt_model"),
        F.col("n_chars").alias("prompt_token_length"),
    )


# ---------------------------------------------------------------- metric samples


def counter_samples(events: DataFrame) -> DataFrame:
    """A counter per (event_type, instance) that only grows and falls back to its start every 1000 events."""
    return events.select(
        F.col("ts"),
        epoch_us(F.col("ts")).alias("ts_us"),
        F.col("event_id").alias("sample_id"),
        F.col("event_type").alias("metric"),
        (F.col("user_id") % 3).cast("int").alias("instance"),
        (small_number() % 25).alias("campaign_id"),
        (F.col("event_id") % 1000).cast("double").alias("value"),
    )


def gauge_samples(events: DataFrame) -> DataFrame:
    """The event value as a gauge per (event_type, instance)."""
    return events.select(
        F.col("ts"),
        epoch_us(F.col("ts")).alias("ts_us"),
        F.col("event_id").alias("sample_id"),
        F.col("event_type").alias("metric"),
        (F.col("user_id") % 3).cast("int").alias("instance"),
        F.col("value"),
    )


def budgets(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("int").alias("campaign_id"),
        (F.col("n_regionkey") * 200 + 100).cast("double").alias("budget"),
    )
