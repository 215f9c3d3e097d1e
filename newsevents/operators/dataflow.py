"""Dataflow control (D1, D2): parallelism for CPU-heavy row work, reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks; without the argument the plan is left alone.

    The reference's ``repartition(parallel)``: worth a shuffle for a small or
    unsplittable input (one gzipped file, one row group) that feeds CPU-heavy
    row work. Nothing is run to find out: the caller decides.
    """
    return df if partitions is None else df.repartition(partitions)


def explode_items(array: Column, pos: bool = False) -> Column:
    """``explode`` of a computed array without Catalyst's inferred size filter.

    For a plain ``explode`` the optimizer adds ``size(array) > 0`` and pushes
    it down - past a ``spread`` repartition, so the whole array expression
    runs twice, once in the single scan task. ``explode_outer`` infers
    nothing; callers drop the null item rows (empty arrays) afterwards.
    """
    return F.posexplode_outer(array) if pos else F.explode_outer(array)
