"""Access to the driver's parquet tables (column-pruned reads)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsevents.session import list_files


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming the columns keeps the scan's ReadSchema narrow.

    Parquet schema inference runs a small Spark job per read; the schema is
    kept on the context with the files (path, length, time) it was read from,
    so a rewritten table is inferred again.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = spark.sparkContext.__dict__.setdefault("_newsevents_schemas", {})
    files = list_files(spark, path)
    if path not in known or known[path][0] != files:
        known[path] = files, spark.read.parquet(path).schema
    df = spark.read.schema(known[path][1]).parquet(path)
    return df.select(*columns) if columns else df
