"""Themes, persons and organizations in the news: counted and ranked.

Counting is one pass: the three lists of a record are tagged and concatenated
in the row (no union of three scans), exploded, and counted with a partial
(map-side) aggregate before the shuffle, so a hot entity costs one row per
map task.

Ranking never gathers a kind into one task. With a limit ``n`` below the
session's ``spark.sql.optimizer.windowGroupLimitThreshold``, Spark's partial
``WindowGroupLimit`` keeps at most ``n`` rows per kind in each map task before
the shuffle. From that threshold on Spark plans no such limit, so ranks come
from a range-partitioned sort plus per-partition offsets, as they do without a
limit (the reference writes every entity). The choice reads the setting only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsevents.operators.dataflow import explode_items
from newsevents.schema import ENTITY_KINDS
from newsevents.session import cut_lineage


def tagged_entities(graph: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """``(kind, entity)``, one row per list item (a missing list gives no rows)."""
    def tag(kind: str):
        # transform() passes an index to a two-argument lambda: close over kind.
        return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("entity"))

    parts = [F.transform(F.coalesce(F.col(col), F.array().cast("array<string>")), tag(kind))
             for kind, col in ENTITY_KINDS if kinds is None or kind in kinds]
    return (graph.select(explode_items(F.concat(*parts)).alias("_e"))
            .where(F.col("_e").isNotNull()).select("_e.kind", "_e.entity"))


def entity_counts(graph: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """``(kind, entity, n)``: list occurrences, a repeat inside one record counts again.

    ``kinds`` counts only those lists; the others are not even read.
    """
    return tagged_entities(graph, kinds).groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n"))


def _rank_order():
    return [F.desc("n"), F.asc("entity")]


def entity_top_n(counts: DataFrame, n: int | None = None) -> DataFrame:
    """``(kind, rank, entity, n)``: rank 1 = most frequent, ties by entity name."""
    if n is None:
        return global_rank(counts)
    if n < 1:
        raise ValueError("n must be positive")
    threshold = int(counts.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n < threshold:
        w = Window.partitionBy("kind").orderBy(*_rank_order())
        # Filter on the bare row_number so Spark inserts a partial WindowGroupLimit.
        return (counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
                .select("kind", F.col("_rn").cast("bigint").alias("rank"), "entity", "n"))
    return global_rank(counts).where(F.col("rank") <= n)


def global_rank(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Dense row numbers per kind over a distributed sort (no single-task window).

    1. range-partition on (kind, -n, entity) and sort within partitions;
    2. tag each row with its partition and position, and write the result to
       the shared folder (``cut_lineage``): the ids must not change between
       the two uses below;
    3. per (partition, kind): row count and first position - at most
       partitions x kinds rows, a proven bound, so it is broadcast;
    4. rank = rows of the kind in earlier partitions + position in own.
    """
    spark = counts.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (counts.repartitionByRange(p, "kind", F.desc("n"), "entity")
               .sortWithinPartitions("kind", F.desc("n"), "entity")
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered)
    heads = (ordered.groupBy("_pid", "kind")
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first")))
    before = Window.partitionBy("kind").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    return (ordered.join(F.broadcast(heads), ["_pid", "kind"])
            .select("kind", (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).alias("rank"),
                    "entity", "n"))
