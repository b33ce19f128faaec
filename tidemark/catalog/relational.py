"""Impression, corpus and table queries: filters, joins, aggregates, windows, sets and partition control."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bridges import corpus, geo_dictionary, impressions, publisher_categories, small_number
from tidemark.catalog.registry import built_once, query, table
from tidemark.functions import baseline, pricing
from tidemark.operators import joins, relational
from tidemark.sources.tables import scan_statistics
from tidemark.streaming.windows import retain

EXCLUDED = ["pub_1", "pub_2", "pub_3"]
PREMIUM = "pub_1"

IMP = """
WITH imp AS (
  SELECT 'tx_' || l_orderkey || '_' || l_linenumber AS transaction_id, 'pub_' || l_suppkey AS publisher_id,
         CAST(l_partkey % 25 AS INT) AS geo_id,
         CASE WHEN l_linenumber < 7 THEN round(l_discount * 100, 2) END AS bid_price,
         CASE l_partkey % 4 WHEN 0 THEN 'Mozilla/5.0 (iPhone)' WHEN 1 THEN 'Mozilla/5.0 (Linux; Android 13)'
              WHEN 2 THEN 'Mozilla/5.0 (X11; Linux)' END AS user_agent,
         CASE l_suppkey % 3 WHEN 0 THEN '192.168.0.1' WHEN 1 THEN '10.0.0.1' ELSE '8.8.8.8' END AS ip_address,
         '{"floor_price":' || l_linenumber || ',"ad_size":"300x250"}' AS bid_request,
         l_extendedprice / 1000 AS price
  FROM lineitem),
docs AS (
  SELECT doc_id AS prompt_id, text AS prompt, source AS category, lang AS prompt_model, n_chars AS prompt_token_length
  FROM documents)
"""
NOT_IN = "publisher_id NOT IN ('pub_1', 'pub_2', 'pub_3')"
SUM_COUNT = IMP + f"""
SELECT geo_id, round(sum(bid_price), 2) AS total_bid, count(*) AS cnt FROM imp WHERE {NOT_IN} GROUP BY geo_id"""


def imp(spark, sf_dir):
    """Impressions made from the line items, stored once for each state of that table."""
    made = impressions(table(spark, sf_dir, "lineitem"))
    path = built_once(spark, sf_dir, "lineitem", "impressions", made.write.parquet)
    return spark.read.schema(made.schema).parquet(path)


def docs(spark, sf_dir):
    return corpus(table(spark, sf_dir, "documents"))


def geo(spark, sf_dir):
    return geo_dictionary(table(spark, sf_dir, "nation"))


# ---------------------------------------------------------------- filters


@query("filter_eq", IMP + "SELECT prompt_id, length(prompt) AS n FROM docs WHERE category = 'src7'")
def filter_eq(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.col("category") == "src7").select(
        "prompt_id", F.length("prompt").cast("bigint").alias("n")
    )


@query("filter_range", IMP + "SELECT transaction_id, publisher_id, bid_price FROM imp WHERE bid_price > 5")
def filter_range(spark, sf_dir):
    return imp(spark, sf_dir).filter(F.col("bid_price") > 5).select("transaction_id", "publisher_id", "bid_price")


@query("filter_not_in", IMP + f"SELECT transaction_id, publisher_id FROM imp WHERE {NOT_IN}")
def filter_not_in(spark, sf_dir):
    kept = imp(spark, sf_dir).filter(~F.col("publisher_id").isin(*EXCLUDED))
    return kept.select("transaction_id", "publisher_id")


# The underscore of LIKE stands for any character, so this is not a prefix test.
@query("filter_like", IMP + "SELECT transaction_id, publisher_id FROM imp WHERE publisher_id LIKE 'pub_1_'")
def filter_like(spark, sf_dir):
    return imp(spark, sf_dir).filter(F.col("publisher_id").like("pub_1_")).select("transaction_id", "publisher_id")


@query("filter_prefix", IMP + "SELECT transaction_id, publisher_id FROM imp WHERE starts_with(publisher_id, 'pub_1')")
def filter_prefix(spark, sf_dir):
    return imp(spark, sf_dir).filter(F.col("publisher_id").startswith("pub_1")).select("transaction_id", "publisher_id")


@query(
    "filter_above_avg_having",
    IMP + "SELECT publisher_id, count(*) AS cnt FROM imp WHERE price > (SELECT avg(price) FROM imp) "
    "GROUP BY publisher_id HAVING count(*) > 20",
)
def filter_above_avg_having(spark, sf_dir):
    return relational.above_average(imp(spark, sf_dir), "publisher_id", "price", 20)


@query(
    "filter_above_avg_having_sql",
    IMP + "SELECT publisher_id, count(*) AS cnt FROM imp WHERE price > (SELECT avg(price) FROM imp) "
    "GROUP BY publisher_id HAVING count(*) > 20",
)
def filter_above_avg_having_sql(spark, sf_dir):
    imp(spark, sf_dir).createOrReplaceTempView("tidemark_impressions")
    return spark.sql(
        "SELECT publisher_id, count(*) AS cnt FROM tidemark_impressions "
        "WHERE price > (SELECT avg(price) FROM tidemark_impressions) GROUP BY publisher_id HAVING cnt > 20"
    )


@query(
    "retention_filter",
    """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-31' - CASE event_type WHEN 'view' THEN INTERVAL 48 HOUR WHEN 'click' THEN INTERVAL 7 DAY
            ELSE INTERVAL 30 DAY END GROUP BY event_type""",
)
def retention_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    as_of = F.lit("2024-01-31").cast("timestamp")
    views, clicks = F.col("event_type") == "view", F.col("event_type") == "click"
    kept = (
        retain(events.filter(views), "ts", "48 hours", as_of)
        .unionByName(retain(events.filter(clicks), "ts", "7 days", as_of))
        .unionByName(retain(events.filter(~views & ~clicks), "ts", "30 days", as_of))
    )
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- column logic


@query(
    "price_category",
    IMP + "SELECT transaction_id, price, CASE WHEN price > 100 THEN 'High' WHEN price > 50 THEN 'Medium' "
    "WHEN price > 10 THEN 'Low' ELSE 'Tiny' END AS price_category FROM imp",
)
def price_category(spark, sf_dir):
    return imp(spark, sf_dir).select(
        "transaction_id", "price", pricing.price_category(F.col("price")).alias("price_category")
    )


BID = """CASE WHEN bid_price IS NULL THEN 'unknown' WHEN bid_price = 0 THEN 'zero' WHEN bid_price < 2 THEN 'low'
              WHEN bid_price < 5 THEN 'medium' ELSE 'high' END"""


@query("bid_category", IMP + f"SELECT transaction_id, publisher_id, {BID} AS bid_category FROM imp")
def bid_category(spark, sf_dir):
    return imp(spark, sf_dir).select(
        "transaction_id", "publisher_id", pricing.bid_category(F.col("bid_price")).alias("bid_category")
    )


@query("normalized_price", IMP + "SELECT transaction_id, round(coalesce(bid_price, 0) / 10, 6) AS normalized_price FROM imp")
def normalized_price(spark, sf_dir):
    price = F.round(pricing.normalized_price(F.col("bid_price")), 6)
    return imp(spark, sf_dir).select("transaction_id", price.alias("normalized_price"))


@query(
    "discounted_price",
    IMP + f"""
SELECT transaction_id, publisher_id, round(p * (1 - (CASE WHEN p > 5 THEN 0.15 WHEN p > 2 THEN 0.1 WHEN p > 1 THEN 0.05
       ELSE 0 END + CASE WHEN publisher_id = '{PREMIUM}' THEN 0.05 ELSE 0 END)), 6) AS discounted_price
FROM (SELECT *, coalesce(bid_price, 0) AS p FROM imp)""",
)
def discounted_price(spark, sf_dir):
    premium = F.col("publisher_id") == PREMIUM
    price = F.round(pricing.discounted_price(F.col("bid_price"), premium), 6)
    return imp(spark, sf_dir).select("transaction_id", "publisher_id", price.alias("discounted_price"))


@query(
    "device_type",
    IMP + """
SELECT transaction_id, CASE WHEN user_agent IS NULL THEN 'unknown' WHEN user_agent LIKE '%iPhone%' OR user_agent LIKE '%iPad%'
       THEN 'ios' WHEN user_agent LIKE '%Android%' THEN 'android' ELSE 'other' END AS device_type FROM imp""",
)
def device_type(spark, sf_dir):
    return imp(spark, sf_dir).select("transaction_id", pricing.device_type(F.col("user_agent")).alias("device_type"))


@query(
    "is_internal",
    IMP + "SELECT transaction_id, ip_address, starts_with(ip_address, '192.168.') OR starts_with(ip_address, '10.') "
    "AS is_internal FROM imp",
)
def is_internal(spark, sf_dir):
    return imp(spark, sf_dir).select(
        "transaction_id", "ip_address", pricing.is_internal_ip(F.col("ip_address")).alias("is_internal")
    )


@query(
    "json_floor_price",
    IMP + "SELECT transaction_id, CAST(json_extract(bid_request, '$.floor_price') AS DOUBLE) AS floor_price FROM imp",
)
def json_floor_price(spark, sf_dir):
    return imp(spark, sf_dir).select(
        "transaction_id", pricing.json_double(F.col("bid_request"), "$.floor_price").alias("floor_price")
    )


# The three above in one pass.
@query(
    "impression_traits",
    IMP + """
SELECT transaction_id, CASE WHEN user_agent IS NULL THEN 'unknown' WHEN user_agent LIKE '%iPhone%' OR user_agent LIKE '%iPad%'
       THEN 'ios' WHEN user_agent LIKE '%Android%' THEN 'android' ELSE 'other' END AS device_type,
       starts_with(ip_address, '192.168.') OR starts_with(ip_address, '10.') AS is_internal,
       CAST(json_extract(bid_request, '$.floor_price') AS DOUBLE) AS floor_price FROM imp""",
)
def impression_traits(spark, sf_dir):
    return imp(spark, sf_dir).select(
        "transaction_id",
        pricing.device_type(F.col("user_agent")).alias("device_type"),
        pricing.is_internal_ip(F.col("ip_address")).alias("is_internal"),
        pricing.json_double(F.col("bid_request"), "$.floor_price").alias("floor_price"),
    )


@query("surrogate_id", "SELECT count(*) AS n, count(*) AS n_distinct FROM lineitem")
def surrogate_id(spark, sf_dir):
    numbered = relational.with_surrogate_id(imp(spark, sf_dir))
    return numbered.agg(F.count("*").alias("n"), F.countDistinct("surrogate_id").alias("n_distinct"))


@query(
    "udf_vs_native",
    IMP + f"SELECT {BID} AS bid_category, count(*) AS n, 0::BIGINT AS rowwise_differs, 0::BIGINT AS arrow_differs FROM imp GROUP BY 1",
)
def udf_vs_native(spark, sf_dir):
    price = F.col("bid_price")
    tagged = imp(spark, sf_dir).select(
        pricing.bid_category(price).alias("bid_category"),
        baseline.bid_category_rowwise(price).alias("rowwise"),
        baseline.bid_category_arrow(price).alias("arrow"),
    )
    return tagged.groupBy("bid_category").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("rowwise") != F.col("bid_category")).alias("rowwise_differs"),
        F.count_if(F.col("arrow") != F.col("bid_category")).alias("arrow_differs"),
    )


@query(
    "udf_vs_native_price",
    IMP + "SELECT geo_id, count(*) AS n, 0::BIGINT AS rowwise_differs, 0::BIGINT AS arrow_differs FROM imp GROUP BY geo_id",
)
def udf_vs_native_price(spark, sf_dir):
    price = F.col("bid_price")
    tagged = imp(spark, sf_dir).select(
        "geo_id",
        pricing.normalized_price(price).alias("native"),
        baseline.normalized_price_rowwise(price).alias("rowwise"),
        baseline.normalized_price_arrow(price).alias("arrow"),
    )
    return tagged.groupBy("geo_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("rowwise") != F.col("native")).alias("rowwise_differs"),
        F.count_if(F.col("arrow") != F.col("native")).alias("arrow_differs"),
    )


# ---------------------------------------------------------------- joins

BY_COUNTRY = IMP + """
SELECT n_name AS country_code, count(*) AS cnt, round(sum(bid_price), 2) AS total_bid
FROM imp JOIN nation ON n_nationkey = geo_id GROUP BY 1"""


def _by_country(joined):
    return joined.groupBy("country_code").agg(
        F.count("*").alias("cnt"), F.round(F.sum("bid_price"), 2).alias("total_bid")
    )


# 25 keys would mean 25 busy tasks, so the shuffle join salts the impressions.
@query("join_shuffle", BY_COUNTRY)
def join_shuffle(spark, sf_dir):
    joined = joins.join_on(imp(spark, sf_dir), geo(spark, sf_dir), ["geo_id"], strategy="merge", salts=32)
    return _by_country(joined)


@query("join_broadcast", BY_COUNTRY)
def join_broadcast(spark, sf_dir):
    return _by_country(joins.join_on(imp(spark, sf_dir), geo(spark, sf_dir), ["geo_id"], strategy="broadcast"))


@query(
    "lookup_category",
    IMP + """
SELECT 'cat_' || s_nationkey AS category, count(*) AS cnt
FROM imp LEFT JOIN supplier ON publisher_id = 'pub_' || s_suppkey GROUP BY 1""",
)
def lookup_category(spark, sf_dir):
    categories = publisher_categories(table(spark, sf_dir, "supplier"))
    joined = joins.join_on(
        imp(spark, sf_dir), categories, ["publisher_id"], how="left", strategy="broadcast", salts=16
    )
    return joined.groupBy("category").agg(F.count("*").alias("cnt"))


@query(
    "anti_new_keys",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def anti_new_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.keys_absent(orders, known, ["o_orderkey"])


@query(
    "semi_known_keys",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN "
    "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def semi_known_keys(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    known = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.keys_present(orders, known, ["o_orderkey"])


# ---------------------------------------------------------------- aggregates


def _small_publishers(df):
    return df.filter(~F.col("publisher_id").isin(*EXCLUDED))


def _sum_count(df):
    return relational.agg_by(
        df, ["geo_id"], total_bid=F.round(F.sum("bid_price"), 2), cnt=F.count("*")
    )


@query("agg_sum_count", SUM_COUNT)
def agg_sum_count(spark, sf_dir):
    return _sum_count(_small_publishers(imp(spark, sf_dir)))


@query("coalesce_agg", SUM_COUNT)
def coalesce_agg(spark, sf_dir):
    return _sum_count(relational.fewer_partitions(_small_publishers(imp(spark, sf_dir)), kept=0.15))


@query("repartition_agg", SUM_COUNT)
def repartition_agg(spark, sf_dir):
    return _sum_count(relational.rebalanced(_small_publishers(imp(spark, sf_dir))))


@query("salted_agg", IMP + "SELECT geo_id, round(sum(price), 2) AS total, count(*) AS cnt FROM imp GROUP BY geo_id")
def salted_agg(spark, sf_dir):
    return relational.salted_agg(imp(spark, sf_dir), ["geo_id"], "price", salts=32).withColumn("total", F.round("total", 2))


@query(
    "agg_multi",
    IMP + """
SELECT publisher_id, round(sum(bid_price), 2) AS total_bid, round(avg(bid_price), 6) AS avg_bid, min(bid_price) AS min_bid,
       max(bid_price) AS max_bid, count(bid_price) AS count_bid FROM imp GROUP BY publisher_id""",
)
def agg_multi(spark, sf_dir):
    return relational.agg_by(
        imp(spark, sf_dir),
        ["publisher_id"],
        total_bid=F.round(F.sum("bid_price"), 2),
        avg_bid=F.round(F.avg("bid_price"), 6),
        min_bid=F.min("bid_price"),
        max_bid=F.max("bid_price"),
        count_bid=F.count("bid_price"),
    )


@query(
    "agg_two_keys",
    IMP + """
SELECT category, prompt_model, round(avg(prompt_token_length), 6) AS avg_input_tokens,
       max(length(prompt)) AS max_chars, count(*) AS count
FROM docs JOIN labels ON doc_id = prompt_id WHERE quality = 1 GROUP BY 1, 2""",
)
def agg_two_keys(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("prompt_id"), F.col("quality").alias("score"))
    sized = docs(spark, sf_dir).withColumn("chars", F.length("prompt")).drop("prompt")
    scored = sized.join(labels, "prompt_id").filter(F.col("score") == 1)
    return relational.agg_by(
        scored,
        ["category", "prompt_model"],
        avg_input_tokens=F.round(F.avg("prompt_token_length"), 6),
        max_chars=F.max("chars").cast("bigint"),
        count=F.count("*"),
    )


@query("agg_minmax", IMP + "SELECT min(prompt_token_length) AS shortest, max(prompt_token_length) AS longest FROM docs")
def agg_minmax(spark, sf_dir):
    scanned = corpus(scan_statistics(spark, f"{sf_dir.rstrip('/')}/documents.parquet"))
    return scanned.agg(F.min("prompt_token_length").alias("shortest"), F.max("prompt_token_length").alias("longest"))


@query("agg_text_len", IMP + "SELECT CAST(sum(length(prompt)) AS BIGINT) AS chars FROM docs WHERE category = 'src7'")
def agg_text_len(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.col("category") == "src7").agg(F.sum(F.length("prompt")).alias("chars"))


@query(
    "agg_fullscan",
    IMP + """
SELECT CAST(sum(length(prompt)) AS BIGINT) AS total_prompt_chars, CAST(sum(length(prompt_model)) AS BIGINT) AS total_model_chars,
       count(DISTINCT category) AS unique_categories, round(avg(prompt_token_length), 6) AS avg_tokens FROM docs""",
)
def agg_fullscan(spark, sf_dir):
    return docs(spark, sf_dir).agg(
        F.sum(F.length("prompt")).alias("total_prompt_chars"),
        F.sum(F.length("prompt_model")).alias("total_model_chars"),
        F.countDistinct("category").alias("unique_categories"),
        F.round(F.avg("prompt_token_length"), 6).alias("avg_tokens"),
    )


@query(
    "agg_by_expr",
    IMP + "SELECT lower(publisher_id) AS pub_lower, round(sum(bid_price), 2) AS total_bid FROM imp "
    "WHERE publisher_id LIKE 'pub_%' GROUP BY 1",
)
def agg_by_expr(spark, sf_dir):
    kept = imp(spark, sf_dir).filter(F.col("publisher_id").like("pub_%"))
    return relational.agg_by(
        kept, [F.lower("publisher_id").alias("pub_lower")], total_bid=F.round(F.sum("bid_price"), 2)
    )


@query(
    "unpivot_score",
    """
SELECT l_suppkey, round(avg(score), 6) AS score, count(score) AS answers FROM (
  SELECT l_suppkey, unnest([l_quantity, l_discount, l_tax]) AS score FROM lineitem) GROUP BY l_suppkey""",
)
def unpivot_score(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem")
    scores = relational.unpivot_mean(wide, ["l_suppkey"], ["l_quantity", "l_discount", "l_tax"])
    return scores.withColumn("score", F.round("score", 6))


HOURS = ", ".join(f'count(*) FILTER (WHERE hour(ts) = {h}) AS "{h}"' for h in range(24))


@query("pivot_hours", f"SELECT event_type, {HOURS} FROM events GROUP BY event_type")
def pivot_hours(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", F.hour("ts").alias("hour"))
    return relational.pivot_count(events, "event_type", "hour", range(24))


# The sketch must land within three standard errors of the exact count.
@query("approx_distinct", "SELECT event_type, 1 AS within_bound FROM events GROUP BY event_type")
def approx_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sketched = relational.approx_distinct(events, ["event_type"], "user_id", rsd=0.02)
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    error = F.abs(F.col("approx") - F.col("exact")) / F.col("exact")
    return sketched.join(exact, "event_type").select(
        "event_type", F.when(error <= 3 * 0.02, 1).otherwise(0).alias("within_bound")
    )


@query(
    "frequent_values",
    "SELECT k AS value, count(*) AS cnt FROM (SELECT CAST(json_extract(props, '$.k') AS INT) AS k FROM events) "
    "GROUP BY k ORDER BY cnt DESC LIMIT 100",
)
def frequent_values(spark, sf_dir):
    numbers = table(spark, sf_dir, "events").select(small_number().alias("k"))
    return relational.frequent_values(numbers, "k", 100)


# ---------------------------------------------------------------- windows, sets


@query(
    "topn_rank",
    IMP + """
SELECT transaction_id, publisher_id, bid_price, rank FROM (
  SELECT *, rank() OVER (PARTITION BY publisher_id ORDER BY bid_price DESC NULLS LAST) AS rank FROM imp) WHERE rank <= 5""",
)
def topn_rank(spark, sf_dir):
    best = relational.top_n(imp(spark, sf_dir), ["publisher_id"], "bid_price", 5)
    return best.select("transaction_id", "publisher_id", "bid_price", "rank")


@query(
    "topn_row_number",
    """
SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
         l_partkey, l_shipdate) AS rank FROM lineitem) WHERE rank <= 5""",
)
def topn_row_number(spark, sf_dir):
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    best = relational.top_n(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", 5, False, ties)
    return best.select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber", "rank")


@query(
    "union_all",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'A' "
    "UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'A'",
)
def union_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return lines.filter(F.col("l_returnflag") == "A").unionByName(lines.filter(F.col("l_returnflag") != "A"))


@query("distinct_keys", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_keys(spark, sf_dir):
    return relational.distinct_keys(table(spark, sf_dir, "lineitem"), "l_suppkey")


# A plain limit promises a number of rows, not which ones.
@query("plain_limit", "SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem LIMIT 1000)")
def plain_limit(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey").limit(1000).agg(F.count("*").alias("n"))
