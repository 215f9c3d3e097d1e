"""Trailing N-calendar-day averages over daily series.

Frame: the days ``[d-(N-1), d]`` that exist; gaps do not widen it; only days
that have data are emitted; the first days get partial frames.

``moving_average`` runs a RANGE window, but not over a whole series at once:
days are cut into buckets of ``bucket_days`` and each bucket also receives the
``N-1`` days before it (a halo). A window task then holds at most
``bucket_days + N - 1`` days per series, so one long series - or one series
holding most of the data - spreads over many tasks; the data grows by only
``1 + (N-1)/bucket_days``. ``moving_average_explode`` is the cartesian form
(each point sent to its N target days, then sum/count) with the same result.

A row without a day lies in no frame: both forms return it with a null average
(the explode form one row per series), so it is seen, and ``check_series`` lists
it. It never counts towards another day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsevents.operators.pairs import pair_daily_avg


def _check_window(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"window must be a positive number of days, got {n!r}")


def moving_average(df: DataFrame, n: int, keys: Sequence[str] = (), day: str = "day",
                   value: str = "value", out: str = "moving_avg",
                   bucket_days: int | None = None) -> DataFrame:
    """Adds ``out`` = mean of ``value`` over the trailing ``n`` calendar days."""
    _check_window(n)
    b = bucket_days or max(366, 8 * n)
    if b < n - 1:
        raise ValueError("bucket_days must be at least n - 1")
    keys = list(keys)
    dnum = F.unix_date(F.col(day))
    home = F.floor(dnum / F.lit(b))
    # Halo: a row also feeds the next bucket when its frame reaches into it.
    reaches_next = dnum + F.lit(n - 1) >= (home + 1) * F.lit(b)
    spread = (df.withColumn("_d", dnum).withColumn("_home", home)
              .withColumn("_bucket", F.explode(F.when(reaches_next, F.array(F.col("_home"), F.col("_home") + 1))
                                               .otherwise(F.array(F.col("_home"))))))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_d").rangeBetween(-(n - 1), 0)
    return (spread.withColumn(out, F.when(F.col("_d").isNotNull(), F.avg(value).over(w)))
            .where(F.col("_bucket").eqNullSafe(F.col("_home")))
            .drop("_d", "_home", "_bucket"))


def moving_average_explode(df: DataFrame, n: int, keys: Sequence[str] = (), day: str = "day",
                           value: str = "value", out: str = "moving_avg",
                           with_value: bool = False) -> DataFrame:
    """Cartesian form: ``(keys, day, out)``; same numbers as ``moving_average``.

    ``with_value`` also returns the day's own ``value`` (its copy with offset
    0; the largest if a day repeats), from the same aggregate - no join back.
    """
    _check_window(n)
    keys = list(keys)
    shifted = (df.select(*keys, day, value,
                         F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_k"))
               .withColumn("_target", F.date_add(F.col(day), F.col("_k"))))
    aggs = [F.sum(value).alias("_s"), F.count(value).alias("_c"), F.min("_k").alias("_pivot")]
    if with_value:
        aggs.append(F.max(F.when(F.col("_k") == 0, F.col(value))).alias("_own"))
    extra = [F.col("_own").alias(value)] if with_value else []
    return (shifted.groupBy(*keys, "_target").agg(*aggs)
            .where(F.col("_pivot") == 0)        # the target day has a point of its own
            .select(*keys, F.col("_target").alias(day), *extra,
                    F.when(F.col("_target").isNotNull(), F.col("_s") / F.col("_c")).alias(out)))


def check_series(df: DataFrame, keys: Sequence[str] = (), day: str = "day",
                 value: str = "value") -> DataFrame:
    """Offending days: more than one row, or an unparseable (null) value.

    Empty result = a valid series (the reference's row-count check, which
    would end the job, becomes a DataFrame the caller can inspect or raise on).
    """
    return (df.groupBy(*keys, day)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.when(F.col(value).isNull(), 1).otherwise(0)).cast("bigint").alias("n_null"))
            .where((F.col("n_rows") > 1) | (F.col("n_null") > 0) | F.col(day).isNull()))


def assert_series(df: DataFrame, **kw) -> None:
    """Raise if ``check_series`` finds anything (reads only one offending row)."""
    bad = check_series(df, **kw).limit(1).collect()
    if bad:
        raise ValueError(f"series is not one value per day: {bad[0].asDict()}")


def pair_trend(events: DataFrame, c1: str, c2: str, n: int = 30,
               measure: str = "goldstein") -> DataFrame:
    """Daily pair average smoothed over a trailing ``n``-day window (flagship)."""
    daily = pair_daily_avg(events, c1, c2, measure)
    return moving_average(daily, n, value=f"avg_{measure}", out="trend")
