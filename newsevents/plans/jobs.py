"""Command-line jobs (``spark-submit newsevents/plans/jobs.py <job> ...``).

One job per capability of the original batch jobs, plus the chained trend:

  pair-average   <events> <out> [--c1 FR --c2 UK]         daily average, TSV
  moving-average <series> <window> <out>                  trailing window, CSV
  pair-trend     <events> <out> [--c1 --c2 --window 30]   both, one plan
  trend-update   <events> <store> [--c1 --c2 --window 30] the same kept up to date: whole days, new or corrected
  top-entities   <graph> <out> [--top N]                  themes/persons/orgs
  extract-content <events> <pages.parquet> <out> [--parallel N]
  cluster        <dir> [--day D] [--k K] [--features N]   TF-IDF + k-means on one day's articles
  follow-topics  <dir> [--k K] [--features N] [--threshold T]  a model for each day, its clusters followed over the days
  stream-pair-average <feed dir> <out> [--c1 --c2] [--once]  running daily averages
                                                          as new daily files arrive

All jobs take --checkpoint-dir: the folder that driver and executors share. What a
job writes there is deleted when it ends.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

from newsevents.operators.articles import attach_content, extract_articles  # noqa: E402
from newsevents.operators.checks import SameCount  # noqa: E402
from newsevents.operators.entities import entity_counts, entity_top_n  # noqa: E402
from newsevents.operators.pairs import pair_daily_avg  # noqa: E402
from newsevents.operators.lineage import THRESHOLD, lineages, transitions  # noqa: E402
from newsevents.operators.sparse_kmeans import fit  # noqa: E402
from newsevents.operators.tfidf import DEFAULT_FEATURES, analyze, tfidf_arrays  # noqa: E402
from newsevents.operators.trend import assert_series, moving_average, pair_trend  # noqa: E402
from newsevents.operators.trend_store import TrendStore  # noqa: E402
from newsevents.session import cut_lineage, delete_scratch, get_spark  # noqa: E402
from newsevents.sinks.writers import (write_articles, write_event_json, write_points,  # noqa: E402
                                      write_ranked, write_series, write_tsv)
from newsevents.sources.feeds import json_records, read_articles, read_events, read_series  # noqa: E402
from newsevents.sources.feeds import read_graph  # noqa: E402


def job_pair_average(spark, a):
    daily = pair_daily_avg(read_events(spark, a.events), a.c1, a.c2)
    write_tsv(daily.orderBy("day"), a.out)


def job_moving_average(spark, a):
    series = read_series(spark, a.series)
    assert_series(series)                      # duplicate days / bad values: stop, as the original did
    check = SameCount()                        # as many days out as in, counted on the way
    averages = moving_average(check.before(series), a.window)
    write_series(averages.select("day", F.col("moving_avg").alias("value")), a.out, check=check)
    check.verify(lambda: read_series(spark, a.out).count())


def job_pair_trend(spark, a):
    t = pair_trend(read_events(spark, a.events), a.c1, a.c2, a.window)
    write_tsv(t.orderBy("day"), a.out)


def job_trend_update(spark, a):
    daily = pair_daily_avg(read_events(spark, a.events), a.c1, a.c2)
    store = TrendStore(spark, a.store, a.window, value="avg_goldstein")
    for day in store.update(daily):
        print(day)


def job_top_entities(spark, a):
    counts = entity_counts(read_graph(spark, a.graph, with_row_id=False))
    if a.top:
        counts = entity_top_n(counts, a.top).drop("rank")
    write_ranked(counts, a.out)


def job_extract_content(spark, a):
    events = read_events(spark, a.events)
    pages = spark.read.parquet(a.pages)
    arts = extract_articles(pages, parallel=a.parallel)
    write_articles(attach_content(events, arts), os.path.join(a.out, "content"))
    write_event_json(events, os.path.join(a.out, "json"))


def job_cluster(spark, a):
    docs = read_articles(spark, os.path.join(a.dir, "content"))
    if a.day:
        # The day's articles: those of its events, which extract-content wrote beside them.
        events = json_records(spark.read.parquet(os.path.join(a.dir, "json")), "json", "day date")
        own = events.where(F.col("json.day") == F.lit(a.day).cast("date")).select("cameo").distinct()
        docs = docs.join(own, "cameo", "left_semi")
    docs = docs.select(F.col("cameo"), F.coalesce("content", F.lit("")).alias("text"))
    model = fit(tfidf_arrays(analyze(docs).select("cameo", "terms"), num_features=a.features), k=a.k)
    write_points(model.assigned, os.path.join(a.dir, "points"))
    cost = model.cost().join(model.groups.select("k"))      # a row each
    cost.select("cost", "n", "k").write.mode("overwrite").json(os.path.join(a.dir, "cost"))


def job_follow_topics(spark, a):
    # Every article on the days of its events, which extract-content wrote beside them.
    events = json_records(spark.read.parquet(os.path.join(a.dir, "json")), "json", "day date")
    days = events.select("cameo", F.col("json.day").alias("day")).where(F.col("day").isNotNull()).distinct()
    docs = read_articles(spark, os.path.join(a.dir, "content")).join(days, "cameo").select("cameo", "day", F.coalesce("content", F.lit("")).alias("text"))
    model = fit(tfidf_arrays(analyze(docs).select("cameo", "day", "terms"), ["day"], num_features=a.features), ["day"], k=a.k)
    write_tsv(model.assigned.select("day", "cluster", "cameo"), os.path.join(a.dir, "topics"))
    centers = cut_lineage(model.centers, "centers")
    moves = cut_lineage(transitions(centers, a.threshold), "moves")
    write_tsv(moves.orderBy("day", "kind", "cluster_from", "cluster_to"), os.path.join(a.dir, "topic-moves"))
    write_tsv(lineages(centers, moves).orderBy("day", "cluster"), os.path.join(a.dir, "topic-lineages"))


def job_stream_pair_average(spark, a):
    from newsevents.streaming.feeds import pair_daily_avg_stream, start, stream_events
    q = start(pair_daily_avg_stream(stream_events(spark, a.feed, max_files_per_trigger=1), a.c1, a.c2),
              "stream_pair_average", sink="parquet", path=a.out, available_now=a.once)
    q.awaitTermination()


def main(argv=None):
    p = argparse.ArgumentParser(prog="newsevents")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("pair-average"); s.add_argument("events"); s.add_argument("out")
    s.add_argument("--c1", default="FR"); s.add_argument("--c2", default="UK")
    s = sub.add_parser("moving-average"); s.add_argument("series"); s.add_argument("window", type=int)
    s.add_argument("out")
    s = sub.add_parser("pair-trend"); s.add_argument("events"); s.add_argument("out")
    s.add_argument("--c1", default="FR"); s.add_argument("--c2", default="UK")
    s.add_argument("--window", type=int, default=30)
    s = sub.add_parser("trend-update"); s.add_argument("events"); s.add_argument("store")
    s.add_argument("--c1", default="FR"); s.add_argument("--c2", default="UK")
    s.add_argument("--window", type=int, default=30)
    s = sub.add_parser("top-entities"); s.add_argument("graph"); s.add_argument("out")
    s.add_argument("--top", type=int, default=None)
    s = sub.add_parser("extract-content"); s.add_argument("events"); s.add_argument("pages")
    s.add_argument("out"); s.add_argument("--parallel", type=int, default=None)
    s = sub.add_parser("cluster"); s.add_argument("dir"); s.add_argument("--k", type=int, default=None)
    s.add_argument("--features", type=int, default=DEFAULT_FEATURES)
    s.add_argument("--day", default=None, help="train on and cluster this day's articles only (yyyy-mm-dd)")
    s = sub.add_parser("follow-topics"); s.add_argument("dir"); s.add_argument("--k", type=int, default=None)
    s.add_argument("--features", type=int, default=DEFAULT_FEATURES)
    s.add_argument("--threshold", type=float, default=THRESHOLD, help="cosine from which two days' clusters are linked")
    s = sub.add_parser("stream-pair-average"); s.add_argument("feed"); s.add_argument("out")
    s.add_argument("--c1", default="FR"); s.add_argument("--c2", default="UK")
    s.add_argument("--once", action="store_true", help="process the files present, then stop")
    for s in sub.choices.values():
        s.add_argument("--checkpoint-dir", default=None, help="folder that driver and executors share")
    a = p.parse_args(argv)
    spark = get_spark(f"newsevents-{a.job}", conf={"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None)
    try:
        _run(spark, a)
    finally:
        delete_scratch(spark)


def _run(spark, a):
    {"pair-average": job_pair_average, "moving-average": job_moving_average,
     "pair-trend": job_pair_trend, "trend-update": job_trend_update, "top-entities": job_top_entities,
     "extract-content": job_extract_content, "cluster": job_cluster, "follow-topics": job_follow_topics,
     "stream-pair-average": job_stream_pair_average}[a.job](spark, a)


if __name__ == "__main__":
    main()
