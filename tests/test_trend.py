import random
from datetime import date, timedelta

import pytest

from newsevents.operators.trend import (assert_series, check_series, moving_average,
                                         moving_average_explode)


def series(spark, points, keyed=False):
    if keyed:
        return spark.createDataFrame(points, "k string, day date, value double")
    return spark.createDataFrame(points, "day date, value double")


def brute(points, n):
    out = {}
    for d, _ in points:
        frame = [v for e, v in points if d - timedelta(days=n - 1) <= e <= d and v is not None]
        out[d] = sum(frame) / len(frame) if frame else None
    return out


def test_gap_does_not_widen_window(spark):  # W1
    pts = [(date(2014, 1, 1), 1.0), (date(2014, 1, 2), 3.0), (date(2014, 1, 5), 5.0), (date(2014, 1, 6), 9.0)]
    got = {r.day: r.moving_avg for r in moving_average(series(spark, pts), 3).collect()}
    assert got == {date(2014, 1, 1): 1.0, date(2014, 1, 2): 2.0, date(2014, 1, 5): 5.0, date(2014, 1, 6): 7.0}


@pytest.mark.parametrize("bucket_days", [None, 29, 40])
def test_long_window_matches_brute_force(spark, bucket_days):  # Q19, halo buckets
    rnd = random.Random(3)
    start = date(2013, 12, 1)
    pts = [(start + timedelta(days=i), float(rnd.randint(-10, 10))) for i in range(90) if rnd.random() < 0.7]
    got = {r.day: r.moving_avg for r in moving_average(series(spark, pts), 30, bucket_days=bucket_days).collect()}
    want = brute(pts, 30)
    assert got.keys() == want.keys()
    assert all(abs(got[d] - want[d]) < 1e-9 for d in want)
    exp = {r.day: r.moving_avg for r in moving_average_explode(series(spark, pts), 30).collect()}
    assert exp.keys() == want.keys() and all(abs(exp[d] - want[d]) < 1e-9 for d in want)


def test_keyed_series(spark):
    pts = [("a", date(2014, 1, 1), 1.0), ("a", date(2014, 1, 2), 3.0), ("b", date(2014, 1, 2), 10.0)]
    got = {(r.k, r.day): r.moving_avg for r in moving_average(series(spark, pts, True), 2, keys=["k"]).collect()}
    assert got == {("a", date(2014, 1, 1)): 1.0, ("a", date(2014, 1, 2)): 2.0, ("b", date(2014, 1, 2)): 10.0}


def test_clock_change_has_no_effect(spark):  # Q20
    pts = [(date(2014, 3, 28) + timedelta(days=i), float(i)) for i in range(5)]
    utc = sorted(tuple(r) for r in moving_average(series(spark, pts), 2).collect())
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        paris = sorted(tuple(r) for r in moving_average(series(spark, pts), 2).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == paris


def test_check_series_lists_duplicates_and_bad_values(spark):  # Q21, Q23, F7
    pts = [(date(2014, 1, 1), 1.0), (date(2014, 1, 1), 2.0), (date(2014, 1, 2), None), (date(2014, 1, 3), 4.0)]
    bad = {r.day: (r.n_rows, r.n_null) for r in check_series(series(spark, pts)).collect()}
    assert bad == {date(2014, 1, 1): (2, 0), date(2014, 1, 2): (1, 1)}
    with pytest.raises(ValueError):
        assert_series(series(spark, pts))
    assert_series(series(spark, pts[2:3][:0] + [(date(2014, 1, 3), 4.0)]))


def test_window_must_be_positive(spark):  # Q21
    with pytest.raises(ValueError):
        moving_average(series(spark, [(date(2014, 1, 1), 1.0)]), 0)
    with pytest.raises(ValueError):
        moving_average_explode(series(spark, [(date(2014, 1, 1), 1.0)]), 0)


def test_explode_form_carries_own_value(spark):
    pts = [(date(2014, 1, 1), 1.0), (date(2014, 1, 2), 3.0), (date(2014, 1, 5), 5.0)]
    got = {r.day: (r.value, r.moving_avg)
           for r in moving_average_explode(series(spark, pts), 3, with_value=True).collect()}
    assert got == {date(2014, 1, 1): (1.0, 1.0), date(2014, 1, 2): (3.0, 2.0), date(2014, 1, 5): (5.0, 5.0)}
