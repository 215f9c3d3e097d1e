import os

from conftest import event_line
from newsevents.plans import jobs


def test_jobs_end_to_end(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "events")
    os.makedirs(feed)
    lines = [event_line(c0=str(i), c1=f"201409{(i % 5) + 1:02d}", c30=str(i % 7), c37="FR", c44="UK",
                        c57=f"http://p/{i % 3}") for i in range(40)]
    with open(os.path.join(feed, "day.export.CSV"), "w") as f:
        f.write("\n".join(lines) + "\n")
    out = os.path.join(tmpdir_path, "out")
    jobs.job_pair_average(spark, type("A", (), {"events": feed, "out": out + "/avg", "c1": "FR", "c2": "UK"}))
    rows = spark.read.option("sep", "\t").csv(out + "/avg").collect()
    assert len(rows) == 5

    from newsevents.sinks.writers import write_series
    from newsevents.operators.pairs import pair_daily_avg
    from newsevents.sources.feeds import read_events
    write_series(pair_daily_avg(read_events(spark, feed), "FR", "UK"), out + "/series", value="avg_goldstein")
    jobs.job_moving_average(spark, type("A", (), {"series": out + "/series", "window": 3, "out": out + "/ma"}))
    assert spark.read.csv(out + "/ma").count() == 5

    pages = spark.createDataFrame([(i, f"http://p/{i}", f"<article><p>{w} story about {w}s</p></article>")
                                   for i, w in enumerate(["apple", "engine", "river"])],
                                  "page_id long, url string, html string")
    pages.write.parquet(out + "/pages")
    jobs.job_extract_content(spark, type("A", (), {"events": feed, "pages": out + "/pages",
                                                    "out": out + "/x", "parallel": 4}))
    assert spark.read.parquet(out + "/x/content").count() == 40
    assert spark.read.parquet(out + "/x/json").count() == 40
    jobs.job_cluster(spark, type("A", (), {"dir": out + "/x", "k": 2, "features": 64, "day": None}))
    assert spark.read.option("sep", "\t").csv(out + "/x/points").count() == 40
    day = spark.read.json(spark.read.parquet(out + "/x/json").select("json").rdd.map(lambda r: r.json)).groupBy("day").count().orderBy("day").first()
    jobs.job_cluster(spark, type("A", (), {"dir": out + "/x", "k": 2, "features": 64, "day": day["day"]}))
    assert spark.read.option("sep", "\t").csv(out + "/x/points").count() == day["count"]     # C3: that day only


def test_write_ranked_one_pass_rank_order(spark, tmpdir_path):  # K2, Q25
    from newsevents.sinks.writers import write_ranked
    counts = spark.createDataFrame([("theme", f"t{i}", i % 7) for i in range(50)] +
                                   [("person", "p1", 3), ("person", "p2", 9)],
                                   "kind string, entity string, n bigint")
    out = os.path.join(tmpdir_path, "ranked")
    write_ranked(counts, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("kind=")) == ["kind=person", "kind=theme"]
    themes = []
    for f in sorted(os.listdir(os.path.join(out, "kind=theme"))):
        if f.startswith("part-"):
            with open(os.path.join(out, "kind=theme", f)) as fh:
                themes += [line.rstrip("\n").split("\t") for line in fh]
    ns = [int(n) for _, n in themes]
    assert len(themes) == 50 and ns == sorted(ns, reverse=True)


def test_cli_pair_trend(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "events")
    os.makedirs(feed)
    lines = [event_line(c0=str(i), c1=f"201409{(i % 9) + 1:02d}", c30=str(i), c37="RS", c44="UP")
             for i in range(30)]
    with open(os.path.join(feed, "f.CSV"), "w") as f:
        f.write("\n".join(lines) + "\n")
    out = os.path.join(tmpdir_path, "trend")
    jobs.main(["pair-trend", feed, out, "--c1", "RS", "--c2", "UP", "--window", "3"])
    rows = spark.read.option("sep", "\t").csv(out).collect()
    assert len(rows) == 9


def test_cli_stream_pair_average_once(spark, tmpdir_path):
    feed = os.path.join(tmpdir_path, "feed")
    os.makedirs(feed)
    for d in (9, 10):
        with open(os.path.join(feed, f"201409{d:02d}.CSV"), "w") as f:
            f.write(event_line(c0=str(d), c1=f"201409{d:02d}", c30="2", c37="FR", c44="UK") + "\n")
    out = os.path.join(tmpdir_path, "stream-out")
    jobs.main(["stream-pair-average", feed, out, "--once"])
    assert spark.read.parquet(out).select("day").distinct().count() == 2


def test_cli_follow_topics(spark, tmpdir_path):  # C2, C3
    feed, out = os.path.join(tmpdir_path, "events"), os.path.join(tmpdir_path, "x")
    os.makedirs(feed)
    # Three days; fruit and engines each day, rivers on the last two.
    topics = {"fruit": "apples pears plums", "engine": "engines wheels brakes", "river": "rivers lakes boats"}
    seen = [(d, t, i) for d in (1, 2, 3) for t in topics if not (d == 1 and t == "river") for i in range(6)]
    with open(os.path.join(feed, "day.export.CSV"), "w") as f:
        f.write("\n".join(event_line(c0=str(n), c1=f"2014090{d}", c57=f"http://p/{t}{i}") for n, (d, t, i) in enumerate(seen)) + "\n")
    pages = [(n, f"http://p/{t}{i}", f"<article><p>{words} {words} extra{chr(97 + i)}</p></article>") for n, (t, i, words) in
             enumerate((t, i, w) for t, w in topics.items() for i in range(6))]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(out + "-pages")
    jobs.main(["extract-content", feed, out + "-pages", out])
    jobs.main(["follow-topics", out, "--k", "3", "--features", "4096"])
    topic = {str(n): (d, t) for n, (d, t, i) in enumerate(seen)}
    rows = spark.read.option("sep", "\t").schema("day string, cluster int, cameo string").csv(out + "/topics").collect()
    of = {}
    for r in rows:
        of.setdefault((int(r.day[-2:]), r.cluster), set()).add(topic[r.cameo])
    assert len(rows) == len(seen) and all(len({t for _, t in x}) == 1 for x in of.values())
    name = {k: next(iter(x))[1] for k, x in of.items()}
    moves = spark.read.option("sep", "\t").schema("day string, next string, kind string, a int, b int, sim double").csv(out + "/topic-moves").collect()
    went_on = {(int(r.day[-2:]), name[int(r.day[-2:]), r.a], name[int(r.next[-2:]), r.b]) for r in moves if r.kind == "continued"}
    assert went_on >= {(2, "fruit", "fruit"), (2, "engine", "engine"), (2, "river", "river")} and all(a == b for _, a, b in went_on)
    assert [name[2, r.b] for r in moves if r.kind == "born" and r.day.endswith("01")] == ["river"]
    ages = spark.read.option("sep", "\t").schema("day string, cluster int, first string, c int, age int").csv(out + "/topic-lineages").collect()
    assert max(r.age for r in ages if r.day.endswith("03") and name[3, r.cluster] == "fruit") == 2
