"""Daily average of an event measure for one actor-country pair (A1, F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pair_filter(events: DataFrame, c1: str, c2: str,
                left: str = "actor1_geo.country_code",
                right: str = "actor2_geo.country_code") -> DataFrame:
    """Rows where ``left == c1 and right == c2``; pushes down to the scan."""
    return events.where((F.col(left) == F.lit(c1)) & (F.col(right) == F.lit(c2)))


def pair_daily_avg(events: DataFrame, c1: str, c2: str, measure: str = "goldstein",
                   day: str = "day", out: str | None = None,
                   left: str = "actor1_geo.country_code",
                   right: str = "actor2_geo.country_code") -> DataFrame:
    """``(day, avg_<measure>)`` over the pair's events; partial + final aggregate.

    Only ``day``, ``measure`` and the two codes are read (column pruning), and
    the equality filters reach the scan.
    """
    out = out or f"avg_{measure}"
    return (pair_filter(events, c1, c2, left, right)
            .groupBy(day).agg(F.avg(measure).alias(out)))


PAIR_SQL = """
SELECT day, AVG({measure}) AS {out}
FROM {view}
WHERE actor1_geo.country_code = :c1 AND actor2_geo.country_code = :c2
GROUP BY day
"""


def pair_daily_avg_sql(spark: SparkSession, events: DataFrame, c1: str, c2: str,
                       measure: str = "goldstein", view: str = "news_events") -> DataFrame:
    """The same average written as Spark SQL over a registered view.

    The country codes are bound as named parameters; only the identifiers
    (measure, view) are part of the text.
    """
    for ident in (measure, view):
        if not ident.replace("_", "").isalnum():
            raise ValueError(f"not a plain identifier: {ident!r}")
    events.createOrReplaceTempView(view)
    return spark.sql(PAIR_SQL.format(measure=measure, out=f"avg_{measure}", view=view),
                     args={"c1": c1, "c2": c2})
