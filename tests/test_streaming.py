import os
from datetime import date

from conftest import event_line
from newsevents.operators.pairs import pair_daily_avg
from newsevents.sources.feeds import read_events
from newsevents.streaming.feeds import (entity_counts_stream, pair_daily_avg_stream, start,
                                        stream_events, stream_graph)


def write_file(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_pair_average_matches_batch(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "feed")
    day1 = [event_line(c0=str(i), c1="20140909", c30=str(i), c37="FR", c44="UK") for i in range(5)]
    day2 = [event_line(c0=str(10 + i), c1="20140910", c30="2", c37="FR", c44="UK") for i in range(3)]
    day2.append(event_line(c0="99", c1="20140909", c30="10", c37="FR", c44="UK"))   # late event
    write_file(feed, "20140909.export.CSV", day1)
    q = start(pair_daily_avg_stream(stream_events(spark, feed), "FR", "UK"), "pair_avg_test",
              mode="complete")
    q.processAllAvailable()
    write_file(feed, "20140910.export.CSV", day2)
    q.processAllAvailable()
    got = {r.day: (r.avg_goldstein, r.n) for r in spark.sql("select * from pair_avg_test").collect()}
    q.stop()
    want = {r.day: r.avg_goldstein for r in pair_daily_avg(read_events(spark, feed), "FR", "UK").collect()}
    assert {d: v[0] for d, v in got.items()} == want
    assert got[date(2014, 9, 9)] == (20 / 6, 6)


def test_stream_entity_counts(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "gkg")
    line = "\t".join(["20140909", "1", "", "T1;T2", "", "anna", "acme", "", "", "", ""])
    write_file(feed, "a.gkg.csv", [line, line])
    q = start(entity_counts_stream(stream_graph(spark, feed)), "entities_test", mode="complete",
              available_now=True)
    q.awaitTermination(120)
    got = {(r.kind, r.entity): r.n for r in spark.sql("select * from entities_test").collect()}
    assert got == {("theme", "T1"): 2, ("theme", "T2"): 2, ("person", "anna"): 2, ("organization", "acme"): 2}


def test_stream_to_parquet_in_update_mode(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "feed")
    write_file(feed, "a.CSV", [event_line(c0="1", c1="20140909", c30="4", c37="FR", c44="UK")])
    out = os.path.join(tmpdir_path, "out")
    q = start(pair_daily_avg_stream(stream_events(spark, feed), "FR", "UK"), "pair_avg_parquet",
              sink="parquet", path=out)
    q.processAllAvailable()
    write_file(feed, "b.CSV", [event_line(c0="2", c1="20140909", c30="6", c37="FR", c44="UK")])
    q.processAllAvailable()
    q.stop()
    rows = spark.read.parquet(out).orderBy("batch_id").collect()
    assert [(r.avg_goldstein, r.n) for r in rows] == [(4.0, 1), (5.0, 2)]


def test_restarted_stream_goes_on(spark, tmpdir_path):
    """Two runs over one folder with a file added in between: no batch twice, latest averages right."""
    feed, out = os.path.join(tmpdir_path, "feed"), os.path.join(tmpdir_path, "out")

    def once():
        q = start(pair_daily_avg_stream(stream_events(spark, feed), "FR", "UK"), "restart_test",
                  sink="parquet", path=out, available_now=True)
        q.awaitTermination(120)

    write_file(feed, "a.CSV", [event_line(c0="1", c1="20140909", c30="4", c37="FR", c44="UK")])
    once()
    once()
    write_file(feed, "b.CSV", [event_line(c0="2", c1="20140909", c30="6", c37="FR", c44="UK"),
                               event_line(c0="3", c1="20140910", c30="1", c37="FR", c44="UK")])
    once()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.batch_id, r.day.day, r.avg_goldstein) for r in rows) == [(0, 9, 4.0), (1, 9, 5.0), (1, 10, 1.0)]
