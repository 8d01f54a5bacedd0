"""Time the headline queries; prints one JSON line.

Every query is run once to warm up and then BENCH_RUNS times (default 3); the median counts.
Results go to a sink that takes every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from quotelane.plans.catalog import BATCH
from quotelane.plans.streams import STREAMS
from quotelane.session import build_session

HEADLINE = (
    "mv_by_account_1m",
    "mv_by_symbol_1m",
    "price_enrich_act",
    "price_enrich_act_many_cusips",
    "price_enrich_symbol",
    "price_enrich_list",
    "price_timer_conflation",
    "position_window_sum_10s",
    "position_window_total",
    "cusip_allocations_10s",
    "symbol_quantity_10s",
    "rolling_quantity",
    "chained_window_rollup",
    "order_split",
    "order_net_positions",
    "kafka_decode_position",
    "kafka_decode_order",
    "kafka_encode_position",
    "word_count_5s",
    "token_count",
    "watermark_late_periodic",
)
STREAMING = ("batches_price_enrich_act", "stream_price_enrich_list")
# Timed beside the others, not in the sum, which stays comparable with earlier runs.
LIVE = ("stream_message_mv_by_symbol", "stream_message_cusip_allocations")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(query) -> float:
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        timed(BATCH[name])
        seconds[name] = round(statistics.median(timed(BATCH[name]) for _ in range(runs)), 3)
    for name in STREAMING:
        timed(STREAMS[name])
        seconds[name] = round(statistics.median(timed(STREAMS[name]) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    for name in LIVE:
        seconds[name] = round(timed(STREAMS[name]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
