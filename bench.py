"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Each query runs to a sink that
keeps nothing. Tables that several queries read (parsed events, impressions) are built in lines of their own, ``build_*``, and
the queries are timed over the stored tables. Every query is planned and run once before its timed run, so that class
loading and code compilation do not count; a query that builds tables of its own builds them again in the timed run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import REGISTRY, logs, relational  # noqa: E402
from tidemark.catalog.registry import forget_built  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.tables import write_noop  # noqa: E402

BUILDS = {"build_events": logs.events, "build_impressions": relational.imp}
HEADLINES = [
    "parse_sessions", "gold_card_hits", "gold_qs_opens", "dash_session_size", "dash_session_quantiles", "dash_top3_series",
    "join_shuffle", "join_broadcast", "agg_sum_count", "coalesce_agg", "repartition_agg", "salted_agg",
    "price_category", "bid_category", "normalized_price", "discounted_price", "device_type", "is_internal", "json_floor_price",
    "impression_traits", "anti_by_sketch", "sketch_distinct_weekly",
    "udf_vs_native", "agg_multi", "topn_rank", "topn_row_number", "filter_above_avg_having",
    "filter_above_avg_having_sql", "agg_by_expr", "agg_text_len", "agg_minmax", "agg_two_keys", "agg_fullscan",
    "scan_csv_roundtrip", "scan_json_roundtrip", "sink_codecs", "append_then_read", "fmt_filtered_count",
    "click_has_impression", "click_burst", "attribution", "metric_increase", "metric_hist_quantile", "alert_sustained",
    "incremental_ingest", "log_profile_kinds", "log_profile_gaps", "src_session_files",
    "stream_daily_counts", "stream_sink", "stream_latest", "stream_attribution",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}

    def timed(name: str, run) -> None:
        began = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    for build in BUILDS.values():
        build(spark, sf_dir)
    forget_built()
    for name, build in BUILDS.items():
        timed(name, lambda: build(spark, sf_dir))
    for name in HEADLINES:
        build = REGISTRY[name].build
        write_noop(build(spark, sf_dir))
        timed(name, lambda: write_noop(build(spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
