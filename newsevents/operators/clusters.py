"""Nearest-center assignment over dense vectors, cost, daily sizes.

Centers are a model: ``k`` rows of ``dim`` numbers. Assignment broadcasts them in
blocks of at most ``BLOCK_CELLS`` numbers and finds each row's nearest center by
a matrix product over Arrow batches (|v|^2 - 2 v.c + |c|^2, then the exact distance
to the center chosen) - one map-only pass, no join, no shuffle, any ``k x dim``.

Models of articles, whose vectors are sparse, are fitted in ``sparse_kmeans``; clusters are
followed from day to day in ``lineage``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsevents.session import cut_lineage

BLOCK_CELLS = 4_000_000   # numbers of one broadcast block of centers (32 MB)


def mean_centers(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``(cluster, center)``: element-wise mean of array vectors per label.

    ``posexplode`` + ``groupBy(label, pos)`` is a partial aggregate, so a
    label holding most rows is combined map-side; each center is then
    re-assembled from ``dim`` rows.
    """
    cells = (df.select(label, F.posexplode(vector).alias("_pos", "_x"))
             .groupBy(label, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m")))
    return (cells.groupBy(label)
            .agg(F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_cells"))
            .select(F.col(label).cast("int").alias("cluster"),
                    F.transform("_cells", lambda c: c["_m"]).alias("center")))


def _blocks(centers: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(ids, matrix)`` blocks of the center table, lowest ids first, of at most ``BLOCK_CELLS`` numbers each."""
    ids: list[int] = []
    rows: list[np.ndarray] = []
    for r in centers.orderBy("cluster").toLocalIterator():
        c = np.asarray(r["center"], float)
        if rows and (len(rows) + 1) * len(c) > BLOCK_CELLS:
            yield np.array(ids), np.stack(rows)
            ids, rows = [], []
        ids.append(int(r["cluster"]))
        rows.append(c)
    if rows:
        yield np.array(ids), np.stack(rows)


def _nearest(shared):
    """Arrow UDF: squared distance to the nearest of one block of centers, and its id."""
    @F.pandas_udf("d double, id int")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        own_ids, c, norms = shared.value
        ok = np.array([v is not None and len(v) == c.shape[1] for v in vectors], bool)
        d, chosen = np.full(len(vectors), np.nan), np.zeros(len(vectors), np.int32)
        if ok.any():
            v = np.stack(vectors[ok].to_list()).astype(float)
            at = (norms - 2 * (v @ c.T)).argmin(1)
            d[ok], chosen[ok] = ((v - c[at]) ** 2).sum(1), own_ids[at]
        return pd.DataFrame({"d": d, "id": chosen})

    return nearest


def assign_clusters(points: DataFrame, centers: DataFrame, vector: str,
                    out: str = "cluster") -> DataFrame:
    """Adds ``out`` (nearest center, ties to the lower id) and ``distance2``.

    A null vector, or one whose length is not the centers', has neither: both
    columns are null. Blocks are read from a written center table, so the
    points are not scanned again for each.
    """
    sc = points.sparkSession.sparkContext
    best = [_nearest(sc.broadcast((ids, matrix, (matrix * matrix).sum(1))))(F.col(vector))
            for ids, matrix in _blocks(cut_lineage(centers, "centers"))]
    if not best:
        raise ValueError("no centers")
    # Structs compare field by field: distance, then id.
    pick = F.least(*best) if len(best) > 1 else best[0]
    found = points.withColumn("_best", pick)
    ok = F.col("_best.d").isNotNull() & ~F.isnan("_best.d")
    return found.select(*points.columns, F.when(ok, F.col("_best.id")).alias(out), F.when(ok, F.col("_best.d")).alias("distance2"))


def cluster_cost(assigned: DataFrame, distance: str = "distance2") -> DataFrame:
    """Sum of squared distances to the nearest center and the points summed, as one row."""
    return assigned.agg(F.sum(distance).alias("cost"), F.count(distance).alias("n_points"))


def daily_cluster_sizes(points: DataFrame, events: DataFrame, id_col: str = "cameo",
                        day: str = "day", cluster: str = "cluster") -> DataFrame:
    """``(day, cluster, n)``: points joined to their event's day, counted."""
    return (points.select(id_col, cluster).join(events.select(id_col, day), id_col)
            .groupBy(day, cluster).agg(F.count(F.lit(1)).alias("n")))
