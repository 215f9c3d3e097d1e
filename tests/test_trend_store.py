import os
import random
from datetime import date, timedelta

import pytest

from newsevents.operators.checks import RowCountError, SameCount
from newsevents.operators.trend import moving_average
from newsevents.operators.trend_store import TrendStore

START = date(2013, 12, 20)


def series(seed, n, gaps=0.3):
    rnd = random.Random(seed)
    return {START + timedelta(days=i): float(rnd.randrange(100)) for i in range(n) if rnd.random() > gaps}


def frame(spark, rows):
    return spark.createDataFrame([(d, v) for d, v in rows.items()], "day date, value double")


def whole(spark, rows, n):
    return {r.day: (r.value, round(r.moving_avg, 9)) for r in moving_average(frame(spark, rows), n).collect()}


def held(store):
    return {r.day: (r.value, round(r.trend, 9)) for r in store.trend().collect()}


def test_increments_equal_the_full_run(spark, tmp_path):
    store = TrendStore(spark, str(tmp_path / "s"), 30)
    assert held(store) == {} and store.update(frame(spark, {})) == []
    every = series(1, 200)
    days = sorted(every)
    have = {}
    for part in (days[40:90], days[:40], days[90:], [days[50], days[60]]):       # also days before, and corrections
        new = {d: every[d] + (1000 if d in have else 0) for d in part}
        have.update(new)
        assert store.update(frame(spark, new)) == sorted(new)
        assert held(store) == whole(spark, have, 30)
    assert store.update(frame(spark, {d: have[d] for d in days[:3]})) == days[:3]      # the same again
    gone = [d for d in days if (d.year, d.month) == (2014, 2)] + [days[3]]
    store.update(frame(spark, {}), days=gone)                                         # a whole month taken back
    for d in gone:
        del have[d]
    assert held(store) == whole(spark, have, 30)


def test_other_months_are_not_opened(spark, tmp_path):
    path = tmp_path / "s"
    store = TrendStore(spark, str(path), 7)
    every = series(2, 400, gaps=0)
    store.update(frame(spark, every))
    day = date(2014, 6, 28)
    # Whatever reads a month that the day and its frame do not touch fails.
    for table in ("daily", "trend"):
        for folder in path.glob(f"{table}/year=*/month=*"):
            y, m = (int(x.partition("=")[2]) for x in folder.parts[-2:])
            if (y, m) not in ((2014, 6), (2014, 7)):
                for f in folder.glob("*.parquet"):
                    os.remove(folder / f".{f.name}.crc") if (folder / f".{f.name}.crc").exists() else None
                    f.write_bytes(b"not parquet")
    assert store.update(frame(spark, {day: 5000.0})) == [day]
    every[day] = 5000.0
    want = whole(spark, every, 7)
    got = {r.day: (r.value, round(r.trend, 9)) for r in store.table("trend", [201406, 201407]).collect()}
    assert got == {d: v for d, v in want.items() if (d.year, d.month) in ((2014, 6), (2014, 7))}


def test_many_series(spark, tmp_path):
    store = TrendStore(spark, str(tmp_path / "s"), 5, keys=["a", "b"], key_types="a string, b string")
    rows = [(a, b, d, v + len(a)) for a, b in (("x", "y"), ("xx", None)) for d, v in series(3, 60).items()]
    df = spark.createDataFrame(rows, "a string, b string, day date, value double")
    store.update(df.where("day < '2014-01-10'"))
    store.update(df.where("day >= '2014-01-10'"))
    want = moving_average(df, 5, keys=["a", "b"], out="trend")
    key = lambda x: sorted((str(r.a), str(r.b), r.day, round(r.trend, 9)) for r in x.collect())
    assert key(store.trend()) == key(want)


def test_same_count(spark, tmp_path):
    df = frame(spark, series(4, 50))

    def run(change):
        check, out = SameCount(), str(tmp_path / str(random.random()))
        check.after(change(check.before(df)).orderBy("day")).write.parquet(out)
        return check.verify(lambda: spark.read.parquet(out).count())

    assert run(lambda x: moving_average(x, 7)) == df.count()
    with pytest.raises(RowCountError):
        run(lambda x: moving_average(x, 7).where("day <> '2014-01-01'").union(moving_average(x, 7).limit(2)))


def test_job_that_loses_a_row_fails(spark, tmp_path, monkeypatch):
    from newsevents.plans import jobs
    from newsevents.sinks.writers import write_series
    write_series(frame(spark, series(5, 40, gaps=0)), str(tmp_path / "in"))
    args = lambda out: type("A", (), {"series": str(tmp_path / "in"), "window": 3, "out": str(tmp_path / out)})
    jobs.job_moving_average(spark, args("good"))
    monkeypatch.setattr(jobs, "moving_average", lambda s, n: moving_average(s, n).where("dayofmonth(day) <> 24"))
    with pytest.raises(RowCountError, match="rows in"):
        jobs.job_moving_average(spark, args("bad"))


def test_cli_trend_update(spark, tmp_path):
    from conftest import event_line
    from newsevents.plans import jobs
    store = str(tmp_path / "store")
    for i, days in enumerate((range(1, 20), range(15, 29))):
        feed = tmp_path / f"feed{i}"
        feed.mkdir()
        (feed / "f.CSV").write_text("\n".join(event_line(c0=str(d), c1=f"201409{d:02d}", c30=str(d + 10 * i), c37="RS", c44="UP") for d in days) + "\n")
        jobs.main(["trend-update", str(feed), store, "--c1", "RS", "--c2", "UP", "--window", "3"])
    got = {r.day.day: (r.avg_goldstein, r.trend) for r in TrendStore(spark, store, 3, value="avg_goldstein").trend().collect()}
    assert len(got) == 28 and got[14] == (14.0, 13.0) and got[15] == (25.0, (13 + 14 + 25) / 3) and got[28] == (38.0, 37.0)
