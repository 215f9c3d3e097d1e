"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE), BENCH_REPEAT (default 2).
Each query is forced with a ``noop`` write (the whole plan runs, nothing is
collected to Python); the reported time per query is the best of the repeats
(the first full-size run of a plan still pays JIT compilation of its hot loops).
Before timing, every query runs once untimed on sf0.001 (JIT and codegen
warm-up, as in a long-running service), and the event and knowledge-graph
feed files are written once from the tables (the input a production run
would find in storage); that setup time is reported as ``setup_seconds``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pair_trend", "pair_daily_avg_sql", "moving_avg_explode", "event_parse", "event_file_scan",
    "moving_avg_by_type", "series_check",
    "graph_parse", "graph_file_scan", "entity_counts", "entity_ranked", "entity_top_10",
    "article_paragraphs", "article_text", "event_content",
    "term_freq", "tfidf", "stemmed_terms", "day_clusters",
    "assign_nearest", "daily_cluster_sizes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from newsevents.session import get_spark
    from newsevents.plans.catalog import QUERIES

    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.local.dir": tempfile.mkdtemp(prefix="newsevents-bench-")}
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="newsevents-bench-ckpt-")
    spark = get_spark("newsevents-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2, conf=conf)

    # Warm-up (untimed): every query once on the smallest data, so class
    # loading, JIT and the generated-code cache are shared by the timed runs.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    # Setup (untimed, reported): the feed files, as they would sit in storage.
    from newsevents.sources.fixtures import feed_files
    t0 = time.perf_counter()
    for kind in ("events", "graph"):
        feed_files(spark, sf_dir, kind)
    setup = round(time.perf_counter() - t0, 3)
    print(f"# setup (feed files written): {setup:.2f}s", file=sys.stderr, flush=True)

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "setup_seconds": setup}))


if __name__ == "__main__":
    main()
