"""Queries over the event feed: parse, pair average, trailing windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.operators.pairs import pair_daily_avg, pair_daily_avg_sql
from newsevents.operators.records import null_empty_structs, parse_events
from newsevents.operators.trend import (check_series, moving_average, moving_average_explode,
                                         pair_trend)
from newsevents.operators.trend_store import TrendStore
from newsevents.plans.catalog import flatten, r6, register
from newsevents.session import shared_dir
from newsevents.sources.feeds import read_events
from newsevents.sources.fixtures import feed_files
from newsevents.sources.tables import table

PAIR = ("NATION_19", "NATION_18")


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as text lines (``value``)."""
    return spark.read.text(feed_files(spark, sf_dir, "events"))


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from the feed's text lines through the ``split`` parser
    (the path for lines that do not come from a CSV scan)."""
    return parse_events(feed_lines(spark, sf_dir))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read from the published feed files by the production CSV reader."""
    return read_events(spark, feed_files(spark, sf_dir, "events"))


# SQL that rebuilds, from the tables, what the event lines say.
EVENT_BASE = """
WITH np AS (SELECT count(*) AS n FROM pages),
base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_returnflag, l.l_linestatus,
         o.o_orderdate, c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
         s.s_suppkey, s.s_name, s.s_nationkey, cn.n_name AS cn_name, sn.n_name AS sn_name,
         p.p_size, pg.url
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN pages pg ON pg.page_id = l.l_orderkey % (SELECT n FROM np)
)"""

_NULL_ACTOR_TAIL = ["ethnic_code", "religion1_code", "religion2_code", "type1_code",
                    "type2_code", "type3_code"]


def _actor_sql(prefix: str, code: str, name: str, country: str, group: str) -> str:
    cols = [f"{code} AS {prefix}_code", f"{name} AS {prefix}_name",
            f"{country} AS {prefix}_country_code", f"{group} AS {prefix}_known_group_code"]
    cols += [f"NULL::VARCHAR AS {prefix}_{f}" for f in _NULL_ACTOR_TAIL]
    return ", ".join(cols)


def _geo_sql(prefix: str, typ: str, name: str, key: str, cond: str | None = None) -> str:
    def w(e: str) -> str:
        return f"CASE WHEN {cond} THEN {e} END" if cond else e
    return ", ".join([
        f"{w(typ)} AS {prefix}_type", f"{w(name)} AS {prefix}_name",
        f"{w(name)} AS {prefix}_country_code", f"NULL::VARCHAR AS {prefix}_adm1_code",
        f"{w(f'CAST({key} AS DOUBLE)')} AS {prefix}_lat",
        f"{w(f'CAST(-{key} AS DOUBLE)')} AS {prefix}_long",
        f"NULL::VARCHAR AS {prefix}_feature_id"])


EVENT_ROWS = EVENT_BASE + """,
ev AS (
  SELECT l_orderkey * 8 + l_linenumber AS cameo,
         CAST(o_orderdate AS DATE) AS day,
         CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(year(o_orderdate) AS DOUBLE) + 0.5 AS frac_date,
         """ + _actor_sql("actor1", "'C' || c_custkey", "c_name", "cn_name", "c_mktsegment") + """,
         """ + _actor_sql("actor2", "'S' || s_suppkey", "s_name", "sn_name", "NULL::VARCHAR") + """,
         l_returnflag = 'R' AS is_root,
         '0' || l_linenumber AS event_code, '0' || l_linenumber AS event_base_code,
         '0' || l_linenumber AS event_root_code,
         l_linenumber AS quad_class, l_quantity AS goldstein, p_size AS num_mentions,
         l_linenumber AS num_sources,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS num_articles,
         l_discount AS avg_tone,
         """ + _geo_sql("actor1_geo", "1", "cn_name", "c_nationkey") + """,
         """ + _geo_sql("actor2_geo", "1", "sn_name", "s_nationkey") + """,
         """ + _geo_sql("event_geo", "4", "cn_name", "c_nationkey", "l_linestatus <> 'F'") + """,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_added,
         CASE WHEN l_linenumber % 2 = 1 THEN url END AS source_url,
         l_linestatus
  FROM base
)"""

PAIR_DAILY_SQL = EVENT_ROWS + f"""
, daily AS (
  SELECT day, AVG(goldstein) AS avg_goldstein FROM ev
  WHERE actor1_geo_country_code = '{PAIR[0]}' AND actor2_geo_country_code = '{PAIR[1]}'
  GROUP BY day
)"""


@register("event_parse", EVENT_ROWS + "\nSELECT * EXCLUDE (l_linestatus) FROM ev")
def q_event_parse(spark, sf_dir):
    """Every event line parsed, all 58 leaves."""
    return flatten(line_events(spark, sf_dir))


@register("event_parse_nulls", EVENT_ROWS + """
SELECT cameo, l_linestatus = 'F' AS event_geo_is_null, source_url IS NULL AS source_url_is_null,
       num_articles IS NULL AS num_articles_is_null, false AS actor2_is_null
FROM ev""")
def q_event_parse_nulls(spark, sf_dir):
    """All-null structs become null; bad or empty tokens become null."""
    ev = null_empty_structs(line_events(spark, sf_dir))
    return ev.select("cameo", F.col("event_geo").isNull().alias("event_geo_is_null"),
                     F.col("source_url").isNull().alias("source_url_is_null"),
                     F.col("num_articles").isNull().alias("num_articles_is_null"),
                     F.col("actor2").isNull().alias("actor2_is_null"))


@register("pair_daily_avg", PAIR_DAILY_SQL + "\nSELECT day, ROUND(avg_goldstein, 6) AS avg_goldstein FROM daily")
def q_pair_daily_avg(spark, sf_dir):
    """Daily average goldstein for one country pair."""
    d = pair_daily_avg(parsed_events(spark, sf_dir), *PAIR)
    return d.select("day", r6("avg_goldstein").alias("avg_goldstein"))


@register("pair_daily_avg_sql", PAIR_DAILY_SQL + "\nSELECT day, ROUND(avg_goldstein, 6) AS avg_goldstein FROM daily")
def q_pair_daily_avg_sql(spark, sf_dir):
    """S7 + A1 through Spark SQL over a registered view."""
    d = pair_daily_avg_sql(spark, parsed_events(spark, sf_dir), *PAIR)
    return d.select("day", r6("avg_goldstein").alias("avg_goldstein"))


def _window_sql(n: int, out: str = "moving_avg") -> str:
    return PAIR_DAILY_SQL + f"""
SELECT day, ROUND(avg_goldstein, 6) AS avg_goldstein,
       ROUND(AVG(avg_goldstein) OVER (ORDER BY day RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING
                                      AND CURRENT ROW), 6) AS {out}
FROM daily"""


def _pair_window(spark, sf_dir, n, explode=False):
    daily = pair_daily_avg(parsed_events(spark, sf_dir), *PAIR)
    if explode:
        ma = moving_average_explode(daily, n, value="avg_goldstein", with_value=True)
    else:
        ma = moving_average(daily, n, value="avg_goldstein")
    return ma.select("day", r6("avg_goldstein").alias("avg_goldstein"), r6("moving_avg").alias("moving_avg"))


@register("moving_avg_7", _window_sql(7))
def q_moving_avg_7(spark, sf_dir):
    """Trailing 7-calendar-day average of the pair series."""
    return _pair_window(spark, sf_dir, 7)


@register("moving_avg_30", _window_sql(30))
def q_moving_avg_30(spark, sf_dir):
    """W1 with N = 30 (the reference's Int overflow case)."""
    return _pair_window(spark, sf_dir, 30)


@register("moving_avg_explode", _window_sql(30))
def q_moving_avg_explode(spark, sf_dir):
    """The cartesian day-offset form of the same window."""
    return _pair_window(spark, sf_dir, 30, explode=True)


@register("moving_avg_by_type", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, AVG(value) AS avg_value
           FROM events GROUP BY 1, 2)
SELECT event_type, day, ROUND(avg_value, 6) AS avg_value,
       ROUND(AVG(avg_value) OVER (PARTITION BY event_type ORDER BY day
             RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM d""")
def q_moving_avg_by_type(spark, sf_dir):
    """W1 keyed: one trailing 7-day series per event type over ``events``."""
    ev = table(spark, sf_dir, "events", "event_type", "ts", "value")
    daily = ev.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("avg_value"))
    ma = moving_average(daily, 7, keys=["event_type"], value="avg_value")
    return ma.select("event_type", "day", r6("avg_value").alias("avg_value"), r6("moving_avg").alias("moving_avg"))


@register("moving_avg_no_day", """
WITH d AS (SELECT event_type, CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS day, AVG(value) AS avg_value
           FROM events GROUP BY 1, 2),
m AS (SELECT event_type, day, AVG(avg_value) OVER (PARTITION BY event_type ORDER BY day
             RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS a FROM d WHERE day IS NOT NULL
      UNION ALL SELECT event_type, NULL, NULL FROM d WHERE day IS NULL)
SELECT form, event_type, day, ROUND(a, 6) AS moving_avg FROM m, (VALUES ('window'), ('explode')) f(form)""")
def q_moving_avg_no_day(spark, sf_dir):
    """W1, J1 on series with rows that have no day: kept with a null average, in both forms alike."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "ts", "value")
    day = F.when(F.col("event_id") % 97 != 0, F.to_date("ts"))
    daily = ev.groupBy("event_type", day.alias("day")).agg(F.avg("value").alias("avg_value"))
    forms = [f(daily, 7, keys=["event_type"], value="avg_value").select(
        F.lit(name).alias("form"), "event_type", "day", r6("moving_avg").alias("moving_avg"))
        for name, f in (("window", moving_average), ("explode", moving_average_explode))]
    return forms[0].unionByName(forms[1])


@register("series_check", EVENT_ROWS + """
SELECT day, count(*) AS n_rows, count(*) FILTER (WHERE num_articles IS NULL) AS n_null
FROM ev GROUP BY day
HAVING count(*) > 1 OR count(*) FILTER (WHERE num_articles IS NULL) > 0""")
def q_series_check(spark, sf_dir):
    """Days that break the one-value-per-day rule (duplicates, bad values)."""
    ev = parsed_events(spark, sf_dir)
    return check_series(ev, day="day", value="num_articles")


@register("pair_trend", _window_sql(30, "trend"))
def q_pair_trend(spark, sf_dir):
    """C1 (flagship): pair daily average smoothed over 30 calendar days."""
    t = pair_trend(parsed_events(spark, sf_dir), *PAIR, n=30)
    return t.select("day", r6("avg_goldstein").alias("avg_goldstein"), r6("trend").alias("trend"))


@register("pair_trend_increments", _window_sql(30, "trend"))
def q_pair_trend_increments(spark, sf_dir):
    """C1 kept up to date: three increments, the last of which corrects days of the second and takes one back."""
    daily = pair_daily_avg(parsed_events(spark, sf_dir), *PAIR)
    later, odd = F.col("day") >= "1995-01-01", F.dayofmonth("day") == 15
    stray = daily.agg(F.lit(date(1991, 12, 31)).alias("day"), F.lit(99.0).alias("avg_goldstein"))
    store = TrendStore(spark, shared_dir(spark, "trend-store"), 30, value="avg_goldstein")
    store.update(daily.where(~later))
    store.update(daily.where(later).withColumn("avg_goldstein", F.when(odd, -1.0).otherwise(F.col("avg_goldstein"))).unionByName(stray))
    store.update(daily.where(later & odd), days=[date(1991, 12, 31)])
    return store.trend().select("day", r6("avg_goldstein").alias("avg_goldstein"), r6("trend").alias("trend"))
