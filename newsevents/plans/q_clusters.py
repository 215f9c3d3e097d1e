"""Queries over ``embeddings``: nearest center, cost, daily cluster sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsevents.operators.clusters import (assign_clusters, cluster_cost, daily_cluster_sizes,
                                            mean_centers)
from newsevents.operators.lineage import lineages, transitions
from newsevents.plans.catalog import r6, register
from newsevents.sources.tables import table

ASSIGN_SQL = """
WITH cells AS (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
  FROM embeddings, range(1, len(embedding) + 1) t(i) GROUP BY label, i
),
centers AS (SELECT CAST(label AS INTEGER) AS cluster, list(m ORDER BY i) AS center FROM cells GROUP BY label),
d AS (
  SELECT e.vec_id, e.label, c.cluster,
         list_sum(list_transform(e.embedding, lambda x, i: (CAST(x AS DOUBLE) - c.center[i]) * (CAST(x AS DOUBLE) - c.center[i]))) AS d2
  FROM embeddings e, centers c
),
best AS (
  SELECT vec_id, label, cluster, d2,
         row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS r
  FROM d
)"""


def _assigned(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return assign_clusters(emb, mean_centers(emb, "label", "embedding"), "embedding")


@register("assign_nearest", ASSIGN_SQL + "\nSELECT vec_id, label, cluster FROM best WHERE r = 1")
def q_assign_nearest(spark, sf_dir):
    """M7: nearest center per point (centers = label means)."""
    return _assigned(spark, sf_dir).select("vec_id", "label", "cluster")


@register("assign_odd_vectors", ASSIGN_SQL + """
SELECT vec_id, CASE WHEN vec_id % 5 > 1 THEN cluster END AS cluster, vec_id % 5 > 1 AS has_distance FROM best WHERE r = 1""")
def q_assign_odd_vectors(spark, sf_dir):
    """M7 with null vectors (every fifth) and vectors cut short (every fifth): no cluster, no distance."""
    emb = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    odd = emb.withColumn("embedding", F.when(F.col("vec_id") % 5 == 1, F.slice("embedding", 1, 3)).when(F.col("vec_id") % 5 > 1, F.col("embedding")))
    a = assign_clusters(odd, mean_centers(emb, "label", "embedding"), "embedding")
    return a.select("vec_id", "cluster", F.col("distance2").isNotNull().alias("has_distance"))


@register("cluster_cost", ASSIGN_SQL + """
SELECT ROUND(sum(d2), 6) AS cost, count(*) AS n_points FROM best WHERE r = 1""")
def q_cluster_cost(spark, sf_dir):
    """M6: sum of squared distances to the nearest center, as a row."""
    c = cluster_cost(_assigned(spark, sf_dir))
    return c.select(r6("cost").alias("cost"), "n_points")


@register("daily_cluster_sizes", ASSIGN_SQL + """
SELECT CAST(ev.ts AS DATE) AS day, b.cluster, count(*) AS n
FROM best b JOIN events ev ON ev.event_id = b.vec_id
WHERE b.r = 1 GROUP BY 1, 2""")
def q_daily_cluster_sizes(spark, sf_dir):
    """Points joined to their event by id, counted per (day, cluster)."""
    points = _assigned(spark, sf_dir).select(F.col("vec_id").alias("cameo"), "cluster")
    events = table(spark, sf_dir, "events", "event_id", "ts").select(
        F.col("event_id").alias("cameo"), F.to_date("ts").alias("day"))
    return daily_cluster_sizes(points, events)


# Each vector is the page of one event, spread over the whole month: its day's centers are the means by label.
LINEAGE_SQL = """
WITH RECURSIVE ratio AS (SELECT (SELECT count(*) FROM events) // (SELECT count(*) FROM embeddings) AS r),
dated AS (SELECT CAST(ev.ts AS DATE) AS day, CAST(e.label AS INTEGER) AS cluster, e.embedding
          FROM embeddings e, ratio, events ev WHERE ev.event_id = e.vec_id * r),
centers AS (SELECT day, cluster, i AS term, avg(CAST(embedding[i] AS DOUBLE)) AS value
            FROM dated, range(1, len(embedding) + 1) t(i) GROUP BY ALL),
days AS (SELECT day, lead(day) OVER (ORDER BY day) AS next, lag(day) OVER (ORDER BY day) AS last FROM (SELECT DISTINCT day FROM centers)),
norms AS (SELECT day, cluster, sqrt(sum(value * value)) AS norm FROM centers GROUP BY ALL),
sims AS (SELECT a.day, b.day AS next, a.cluster AS a, b.cluster AS b, sum(a.value * b.value) / any_value(na.norm * nb.norm) AS sim
         FROM centers a JOIN days d ON a.day = d.day JOIN centers b ON b.day = d.next AND b.term = a.term
         JOIN norms na ON na.day = a.day AND na.cluster = a.cluster JOIN norms nb ON nb.day = b.day AND nb.cluster = b.cluster
         GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY day, a ORDER BY sim DESC, b) AS ra, row_number() OVER (PARTITION BY next, b ORDER BY sim DESC, a) AS rb
         FROM sims WHERE sim >= 0.7),
moves AS (
  SELECT day, next AS next_day, CASE WHEN ra = 1 AND rb = 1 THEN 'continued' WHEN rb = 1 THEN 'split' ELSE 'merged' END AS kind,
         a AS cluster_from, b AS cluster_to, sim AS similarity FROM best WHERE ra = 1 OR rb = 1
  UNION ALL
  SELECT d.last, n.day, 'born', NULL, n.cluster, NULL FROM norms n JOIN days d ON n.day = d.day
  WHERE d.last IS NOT NULL AND NOT EXISTS (SELECT 1 FROM best b WHERE b.next = n.day AND b.b = n.cluster)
  UNION ALL
  SELECT n.day, d.next, 'died', n.cluster, NULL, NULL FROM norms n JOIN days d ON n.day = d.day
  WHERE d.next IS NOT NULL AND NOT EXISTS (SELECT 1 FROM best b WHERE b.day = n.day AND b.a = n.cluster)
),
chain AS (
  SELECT n.day, n.cluster, n.day AS first_day, n.cluster AS first_cluster, 0 AS age FROM norms n
  WHERE NOT EXISTS (SELECT 1 FROM moves m WHERE m.kind = 'continued' AND m.next_day = n.day AND m.cluster_to = n.cluster)
  UNION ALL
  SELECT m.next_day, m.cluster_to, c.first_day, c.first_cluster, c.age + 1 FROM chain c
  JOIN moves m ON m.kind = 'continued' AND m.day = c.day AND m.cluster_from = c.cluster
)"""


def _day_centers(spark, sf_dir):
    """``day, cluster, term, value``: mean vector of each label on each day."""
    emb = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    events = table(spark, sf_dir, "events", "event_id", "ts")
    ratio = F.floor(events.agg(F.count(F.lit(1))).scalar() / emb.agg(F.count(F.lit(1))).scalar())
    dated = (emb.withColumn("event_id", F.col("vec_id") * ratio).join(events, "event_id")
             .select(F.to_date("ts").alias("day"), F.col("label").cast("int").alias("cluster"), F.posexplode("embedding").alias("term", "x")))
    return dated.groupBy("day", "cluster", "term").agg(F.avg(F.col("x").cast("double")).alias("value"))


@register("cluster_transitions", LINEAGE_SQL + """
SELECT day, next_day, kind, cluster_from, cluster_to, ROUND(similarity, 6) AS similarity FROM moves""")
def q_cluster_transitions(spark, sf_dir):
    """From each day to the next, which clusters go on, split off, merge, are born and die (centers = label means by day)."""
    moves = transitions(_day_centers(spark, sf_dir), threshold=0.7)
    return moves.select("day", "next_day", "kind", "cluster_from", "cluster_to", r6("similarity").alias("similarity"))


@register("cluster_lineage", LINEAGE_SQL + """
SELECT day, cluster, first_day, first_cluster, age FROM chain""")
def q_cluster_lineage(spark, sf_dir):
    """Where each day's cluster began, and how many days it has gone on."""
    centers = _day_centers(spark, sf_dir)
    return lineages(centers, transitions(centers, threshold=0.7))
