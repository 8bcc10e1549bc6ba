"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   input folder, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_RUNS     timed runs per query after one warm-up, default 3; the median counts
BENCH_QUERIES  comma-separated names, default the headline list
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressgauge.queries import registry
from pressgauge.session import build_session

HEADLINE = [
    "stock_daily", "stock_hourly", "event_metrics", "event_hourly", "relation_top", "term_cosine",
    "pagerank", "label_propagation", "textrank", "doc_sentiment", "pos_rule_sentiment", "training_sets",
    "word_frequency", "url_decode", "nb_predict", "stream_hourly_visit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "pressgauge-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "20g",
            "spark.pressgauge.inputSplits": cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    available = registry()
    seconds = {}
    for name in names:
        query = available[name][0]
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # Every column of every row is computed; nothing is kept.
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
