"""Queries over the file sources and sinks: feed files written, then scanned.

Each writes its input under the session's shared folder (``spark.checkpoint.dir``)
and reads it back with the production readers, so the CSV/text sources, the
row key and the writers are checked against the same SQL as the in-memory path.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsevents.operators.articles import attach_content, extract_articles
from newsevents.operators.entities import entity_counts
from newsevents.operators.pairs import pair_daily_avg
from newsevents.operators.clusters import assign_clusters, mean_centers
from newsevents.operators.records import parse_events, with_row_key, with_unique_row_key
from newsevents.operators.trend import moving_average
from newsevents.plans.catalog import r6, register
from newsevents.plans.q_articles import ARTICLES_SQL
from newsevents.plans.q_events import (EVENT_BASE, EVENT_ROWS, PAIR, PAIR_DAILY_SQL, _window_sql,
                                       feed_lines, parsed_events)
from newsevents.plans.q_graph import ENTITY_SQL, feed_graph
from newsevents.session import shared_dir
from newsevents.sinks.writers import (write_articles, write_event_json, write_points, write_ranked,
                                      write_series, write_tsv)
from newsevents.sources.feeds import json_records, read_articles, read_events, read_graph, read_series
from newsevents.sources.fixtures import event_lines, graph_lines, write_lines
from newsevents.sources.tables import table


def _event_line_sql() -> str:
    """The event line text, field by field, as the fixture builder writes it."""
    f = ["''"] * 58
    f[0] = "CAST(l_orderkey * 8 + l_linenumber AS VARCHAR)"
    f[1] = "strftime(o_orderdate, '%Y%m%d')"
    f[2] = "strftime(o_orderdate, '%Y%m')"
    f[3] = "strftime(o_orderdate, '%Y')"
    f[4] = "strftime(o_orderdate, '%Y') || '.5'"
    f[5], f[6], f[7], f[8] = "'C' || c_custkey", "c_name", "cn_name", "c_mktsegment"
    f[15], f[16], f[17] = "'S' || s_suppkey", "s_name", "sn_name"
    f[25] = "CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END"
    f[26] = f[27] = f[28] = "'0' || l_linenumber"
    f[29], f[30] = "CAST(l_linenumber AS VARCHAR)", "printf('%.2f', l_quantity)"
    f[31], f[32] = "CAST(p_size AS VARCHAR)", "CAST(l_linenumber AS VARCHAR)"
    f[33] = "CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END"
    f[34] = "printf('%.2f', l_discount)"
    for start, typ, name, key, cond in ((35, "1", "cn_name", "c_nationkey", None),
                                        (42, "1", "sn_name", "s_nationkey", None),
                                        (49, "4", "cn_name", "c_nationkey", "l_linestatus <> 'F'")):
        block = [f"'{typ}'", name, name, "''", f"CAST({key} AS VARCHAR)", f"CAST(-{key} AS VARCHAR)", "''"]
        if cond:
            block = [f"CASE WHEN {cond} THEN {b} ELSE '' END" for b in block]
        f[start:start + 7] = block
    f[56] = f[1]
    f[57] = "CASE WHEN l_linenumber % 2 = 1 THEN coalesce(url, '') ELSE '' END"
    return "concat_ws(chr(9), " + ", ".join(f"coalesce({x}, '')" for x in f) + ")"


@register("row_key", EVENT_BASE + f"""
SELECT l_orderkey * 8 + l_linenumber AS cameo, md5('lineitem-' || {_event_line_sql()}) AS row_id
FROM base""")
def q_row_key(spark, sf_dir):
    """md5 row key of each feed line (source name + line text)."""
    lines = with_row_key(feed_lines(spark, sf_dir), "lineitem")
    return parse_events(lines, keep=["row_id"]).select("cameo", "row_id")


@register("row_key_repeated", EVENT_BASE + f""",
lines AS (SELECT l_orderkey * 8 + l_linenumber AS cameo, {_event_line_sql()} AS line FROM base),
every AS (SELECT cameo, line FROM lines, range(0, 3) t(i) WHERE i <= cameo % 3),
placed AS (SELECT cameo, md5('lineitem-' || line) AS first, row_number() OVER (PARTITION BY line) - 1 AS place FROM every)
SELECT cameo, CASE WHEN place = 0 THEN first ELSE md5(first || '-' || place) END AS row_id FROM placed""")
def q_row_key_repeated(spark, sf_dir):
    """A feed that says each line once, twice or three times has a key for each line."""
    lines = feed_lines(spark, sf_dir)
    again = F.expr("array_repeat(value, int(1 + try_cast(split_part(value, '\t', 1) as bigint) % 3))")
    keyed = with_unique_row_key(lines.select(F.explode(again).alias("value")), "lineitem")
    return parse_events(keyed, keep=["row_id"]).select("cameo", "row_id")


@register("json_fields", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_fields(spark, sf_dir):
    """JSON text column parsed with a fixed schema; field by name."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    schema = T.StructType([T.StructField("k", T.IntegerType(), True)])
    return json_records(ev, "props", schema).select("event_id", "event_type", F.col("props.k").alias("k"))


@register("json_inferred", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_inferred(spark, sf_dir):
    """The schema inferred from every JSON text, then the field by name."""
    ev = table(spark, sf_dir, "events", "event_id", "props")
    return json_records(ev, "props").select("event_id", F.col("props.k").alias("k"))


@register("event_file_scan", PAIR_DAILY_SQL + "\nSELECT day, ROUND(avg_goldstein, 6) AS avg_goldstein FROM daily")
def q_event_file_scan(spark, sf_dir):
    """Event feed written as TSV text, scanned by the CSV source (filter pushed down)."""
    path = shared_dir(spark, "event-feed")
    write_lines(event_lines(spark, sf_dir), path)
    d = pair_daily_avg(read_events(spark, path), *PAIR)
    return d.select("day", r6("avg_goldstein").alias("avg_goldstein"))


@register("graph_file_scan", ENTITY_SQL + "\nSELECT kind, entity, n FROM counts")
def q_graph_file_scan(spark, sf_dir):
    """Graph feed (with header line) written as text, scanned, counted."""
    path = shared_dir(spark, "graph-feed")
    write_lines(graph_lines(spark, sf_dir), path)
    return entity_counts(read_graph(spark, path, with_row_id=False))


@register("series_roundtrip", _window_sql(7))
def q_series_roundtrip(spark, sf_dir):
    """S3, K3: pair series written as ``yyyyMMdd,value``, read back, 7-day window."""
    path = shared_dir(spark, "series")
    daily = pair_daily_avg(parsed_events(spark, sf_dir), *PAIR)
    write_series(daily, path, value="avg_goldstein")
    back = read_series(spark, path)
    ma = moving_average(back, 7)
    return ma.select("day", r6("value").alias("avg_goldstein"), r6("moving_avg").alias("moving_avg"))


@register("articles_roundtrip", EVENT_ROWS + ",\n" + ARTICLES_SQL.strip()[len("WITH "):] + """
SELECT ev.cameo, art.title, md5(art.content) AS content_md5
FROM ev JOIN art ON ev.source_url = art.url""")
def q_articles_roundtrip(spark, sf_dir):
    """Event articles written as Parquet and read back."""
    path = shared_dir(spark, "articles")
    arts = extract_articles(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    write_articles(attach_content(parsed_events(spark, sf_dir), arts), path)
    back = read_articles(spark, path)
    return back.select("cameo", "title", F.md5("content").alias("content_md5"))


def _follows(spark, path, schema, folder, *order):
    """The lines of a TSV folder with ``in_order``: does the line before it in its file sort before it?

    Windows are per file (and folder), so no more than a file meets in one task.
    """
    back = spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)
    placed = back.withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.monotonically_increasing_id())
    here = F.struct(*order)
    w = Window.partitionBy(*folder, "_file").orderBy("_at")
    return placed.withColumn("_before", F.lag(here).over(w)).withColumn(
        "in_order", F.coalesce(F.col("_before") < here, F.lit(True)))


@register("pair_average_tsv", PAIR_DAILY_SQL + "\nSELECT day, ROUND(avg_goldstein, 6) AS avg_goldstein, TRUE AS in_order FROM daily")
def q_pair_average_tsv(spark, sf_dir):
    """``day \\t avg`` text written and read back."""
    path = shared_dir(spark, "pair-average")
    write_tsv(pair_daily_avg(parsed_events(spark, sf_dir), *PAIR).orderBy("day"), path)
    back = _follows(spark, path, "day date, avg_goldstein double", [], "day")
    return back.select("day", r6("avg_goldstein").alias("avg_goldstein"), "in_order")


@register("ranked_files", ENTITY_SQL + """
SELECT kind, entity, n, TRUE AS in_order FROM counts
UNION ALL SELECT 'person', ' ' || entity || ' ', n, TRUE FROM counts WHERE kind = 'person'""")
def q_ranked_files(spark, sf_dir):
    """K2, Q25: ranked ``entity \\t n`` files, one folder per kind, in one write."""
    path = shared_dir(spark, "ranked")
    counts = entity_counts(feed_graph(spark, sf_dir))
    # Persons once more with blanks around the name, which must come back.
    padded = counts.where("kind = 'person'").withColumn("entity", F.concat(F.lit(" "), "entity", F.lit(" ")))
    write_ranked(counts.unionByName(padded), path)
    return _follows(spark, path, "entity string, n bigint, kind string", ["kind"], -F.col("n"), "entity") \
        .select("kind", "entity", "n", "in_order")


@register("event_json_roundtrip", EVENT_ROWS + """
SELECT cameo, day, goldstein, actor1_geo_country_code AS actor1_country,
       l_linestatus = 'F' AS no_event_geo
FROM ev""")
def q_event_json_roundtrip(spark, sf_dir):
    """Every event written as JSON (nulls left out) and parsed back."""
    path = shared_dir(spark, "event-json")
    write_event_json(parsed_events(spark, sf_dir), path)
    schema = ("cameo bigint, day date, goldstein double, actor1_geo struct<country_code: string>, "
              "event_geo struct<type: int>")
    back = json_records(spark.read.parquet(path), "json", schema)
    return back.select(F.col("json.cameo").alias("cameo"), F.col("json.day").alias("day"),
                       F.col("json.goldstein").alias("goldstein"),
                       F.col("json.actor1_geo.country_code").alias("actor1_country"),
                       F.col("json.event_geo").isNull().alias("no_event_geo"))


@register("points_roundtrip", """
WITH cells AS (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
  FROM embeddings, range(1, len(embedding) + 1) t(i) GROUP BY label, i
),
centers AS (SELECT CAST(label AS INTEGER) AS cluster, list(m ORDER BY i) AS center FROM cells GROUP BY label),
d AS (
  SELECT e.vec_id, c.cluster,
         list_sum(list_transform(e.embedding, lambda x, i: (CAST(x AS DOUBLE) - c.center[i]) * (CAST(x AS DOUBLE) - c.center[i]))) AS d2
  FROM embeddings e, centers c
)
SELECT cluster, vec_id AS cameo FROM (
  SELECT vec_id, cluster, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS r FROM d
) WHERE r = 1""")
def q_points_roundtrip(spark, sf_dir):
    """K6: ``cluster \\t id`` points written as text and read back."""
    emb = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    pts = assign_clusters(emb, mean_centers(emb, "label", "embedding"), "embedding")
    path = shared_dir(spark, "points")
    write_points(pts.select("cluster", F.col("vec_id").alias("cameo")), path)
    return spark.read.schema("cluster int, cameo bigint").option("sep", "\t").csv(path)
