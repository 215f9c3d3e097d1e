"""Queries over the knowledge-graph feed: parse, entity counts and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.operators.entities import entity_counts, entity_top_n
from newsevents.operators.records import parse_graph
from newsevents.operators.dataflow import explode_items
from newsevents.plans.catalog import register
from newsevents.sources.feeds import read_graph
from newsevents.sources.fixtures import feed_files


def parsed_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph records: the feed's text lines through ``parse_graph`` (no row key)."""
    return parse_graph(spark.read.text(feed_files(spark, sf_dir, "graph")))


def feed_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph records read from the published feed files by the production reader."""
    return read_graph(spark, feed_files(spark, sf_dir, "graph"), with_row_id=False)


# SQL stating, per order, what its graph line says.
GRAPH_BASE = """
WITH np AS (SELECT count(*) AS n FROM pages),
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, p.p_type, s.s_name, s.s_nationkey, n.n_name
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT p_type) AS n_themes,
         count(DISTINCT s_name) AS n_orgs, count(DISTINCT s_nationkey) AS n_snat
  FROM lines GROUP BY l_orderkey
),
g AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS date,
         CAST(coalesce(po.n_lines, 0) AS INTEGER) AS num, cn.n_name AS cn_name,
         c.c_name, c.c_nationkey, coalesce(po.n_themes, 0) AS n_themes,
         coalesce(po.n_orgs, 0) AS n_orgs, coalesce(po.n_snat, 0) AS n_snat,
         o.o_totalprice, o.o_orderpriority
  FROM orders o
  LEFT JOIN per_order po ON o.o_orderkey = po.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
)"""


@register("graph_parse", GRAPH_BASE + """
SELECT date, num, 'ORDER#' || num || '#' || cn_name AS counts, coalesce(t.themes, '') AS themes,
       CAST(1 + n_snat AS INTEGER) AS n_locations, c_name AS persons, coalesce(s.orgs, '') AS organizations,
       coalesce(i.ids, '') AS cameos, o_orderpriority AS sources, p1.url || ' ' || p2.url AS urls
FROM g
LEFT JOIN (SELECT l_orderkey, string_agg(p_type, '|' ORDER BY p_type) AS themes
           FROM (SELECT DISTINCT l_orderkey, p_type FROM lines) GROUP BY 1) t ON t.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, string_agg(s_name, '|' ORDER BY s_name) AS orgs
           FROM (SELECT DISTINCT l_orderkey, s_name FROM lines) GROUP BY 1) s ON s.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, string_agg(CAST(l_orderkey * 8 + l_linenumber AS VARCHAR), '|' ORDER BY l_linenumber) AS ids
           FROM lines GROUP BY 1) i ON i.l_orderkey = o_orderkey
JOIN pages p1 ON p1.page_id = o_orderkey % (SELECT n FROM np)
JOIN pages p2 ON p2.page_id = (o_orderkey + 1) % (SELECT n FROM np)""")
def q_graph_parse(spark, sf_dir):
    """Graph lines parsed; header dropped; blank items and bad ids dropped."""
    g = parsed_graph(spark, sf_dir)
    whole = [F.array_join(F.col(c).cast("array<string>"), "|").alias(c)
             for c in ("counts", "themes", "persons", "organizations", "cameos", "sources")]
    return g.select("date", "num", *whole, F.size("locations").alias("n_locations"),
                    F.array_join("urls", " ").alias("urls"))


@register("graph_locations", GRAPH_BASE + """
, snat AS (
  SELECT l_orderkey, s_nationkey, n_name,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY s_nationkey, n_name) AS pos
  FROM (SELECT DISTINCT l_orderkey, s_nationkey, n_name FROM lines)
)
SELECT date, num, 0 AS pos, 1 AS type, cn_name AS name, cn_name AS country, NULL::VARCHAR AS adm,
       CAST(c_nationkey AS DOUBLE) AS latitude, CAST(-c_nationkey AS DOUBLE) AS longitude,
       NULL::VARCHAR AS feature
FROM g
UNION ALL
SELECT g.date, g.num, CAST(snat.pos AS INTEGER), 1, snat.n_name, snat.n_name, NULL::VARCHAR,
       CAST(snat.s_nationkey AS DOUBLE), CAST(-snat.s_nationkey AS DOUBLE), NULL::VARCHAR
FROM g JOIN snat ON g.o_orderkey = snat.l_orderkey""")
def q_graph_locations(spark, sf_dir):
    """``;`` list of ``#`` records -> array of structs, one row per location."""
    g = parsed_graph(spark, sf_dir)
    return (g.select("date", "num", explode_items(F.col("locations"), pos=True).alias("pos", "loc"))
            .where(F.col("loc").isNotNull()).select("date", "num", "pos", "loc.*"))


@register("graph_tones", GRAPH_BASE + """
SELECT date, num, o_totalprice AS average_tone, 1.5::DOUBLE AS positive_score,
       NULL::DOUBLE AS negative_score, 3.0::DOUBLE AS polarity, 4.0::DOUBLE AS activity_density,
       5.0::DOUBLE AS group_density
FROM g""")
def q_graph_tones(spark, sf_dir):
    """P2c, P2d: ``,`` record of six doubles; bad token -> null, 7th token ignored."""
    g = parsed_graph(spark, sf_dir)
    return g.select("date", "num", "tones.*")


@register("graph_urls", GRAPH_BASE + """
SELECT g.date, 0 AS pos, p.url FROM g JOIN pages p ON p.page_id = g.o_orderkey % (SELECT n FROM np)
UNION ALL
SELECT g.date, 1 AS pos, p.url FROM g JOIN pages p ON p.page_id = (g.o_orderkey + 1) % (SELECT n FROM np)""")
def q_graph_urls(spark, sf_dir):
    """``<UDIV>``-separated url list, one row per url."""
    g = parsed_graph(spark, sf_dir)
    return (g.select("date", explode_items(F.col("urls"), pos=True).alias("pos", "url"))
            .where(F.col("url").isNotNull()))


ENTITY_SQL = GRAPH_BASE + """
, counts AS (
  SELECT 'person' AS kind, c_name AS entity, count(*) AS n FROM g GROUP BY c_name
  UNION ALL
  SELECT 'organization', s_name, count(*) FROM (SELECT DISTINCT l_orderkey, s_name FROM lines) GROUP BY s_name
  UNION ALL
  SELECT 'theme', p_type, count(*) FROM (SELECT DISTINCT l_orderkey, p_type FROM lines) GROUP BY p_type
),
ranked AS (
  SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY n DESC, entity) AS rank, entity, n
  FROM counts
)"""


@register("entity_counts", ENTITY_SQL + "\nSELECT kind, entity, n FROM counts")
def q_entity_counts(spark, sf_dir):
    """Tagged lists exploded and counted per (kind, entity)."""
    return entity_counts(feed_graph(spark, sf_dir))


@register("entity_top_10", ENTITY_SQL + "\nSELECT kind, rank, entity, n FROM ranked WHERE rank <= 10")
def q_entity_top_10(spark, sf_dir):
    """T2 with N = 10: ten most frequent per kind, ties by name."""
    return entity_top_n(entity_counts(feed_graph(spark, sf_dir)), 10)


@register("entity_top_2000", ENTITY_SQL + "\nSELECT kind, rank, entity, n FROM ranked WHERE rank <= 2000")
def q_entity_top_2000(spark, sf_dir):
    """T2 with a large N: past the partial group limit, by the distributed rank."""
    return entity_top_n(entity_counts(feed_graph(spark, sf_dir)), 2000)


@register("entity_ranked", ENTITY_SQL + "\nSELECT kind, rank, entity, n FROM ranked")
def q_entity_ranked(spark, sf_dir):
    """T1, T2 as the reference runs it (no N): every entity with its rank."""
    return entity_top_n(entity_counts(feed_graph(spark, sf_dir)), None)


@register("top_themes", ENTITY_SQL + "\nSELECT rank, entity, n FROM ranked WHERE kind = 'theme'")
def q_top_themes(spark, sf_dir):
    """F3 + T2: the ranked theme list."""
    ranked = entity_top_n(entity_counts(feed_graph(spark, sf_dir), ["theme"]), None)
    return ranked.select("rank", "entity", "n")
