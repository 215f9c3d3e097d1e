"""File sources for the feeds and the job hand-over formats."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsevents import schema as S
from newsevents.functions.parsing import to_date, to_double
from newsevents.operators.records import parse_event_csv_columns, parse_graph, with_unique_row_key


def read_event_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw CSV scan: 58 string columns, tab separated, no quoting.

    Short lines give nulls, extra columns are ignored, blank lines skipped,
    ``.gz`` files decoded - all by Spark's CSV source, which also splits
    large files across tasks.
    """
    return (spark.read.schema(S.raw_event_schema())
            .option("sep", "\t").option("quote", "").option("escape", "")
            .option("nullValue", "").option("mode", "PERMISSIVE").option("header", "false")
            .csv(path))


def read_events(spark: SparkSession, path: str | list[str], with_path: bool = False) -> DataFrame:
    """Event feed files -> typed event rows (``parse_events`` schema)."""
    raw = read_event_columns(spark, path)
    keep = []
    if with_path:
        raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
        keep = ["source_file"]
    return parse_event_csv_columns(raw, keep)


def read_graph(spark: SparkSession, path: str | list[str], with_row_id: bool = True) -> DataFrame:
    """Knowledge-graph files -> typed rows, each with a stable ``row_id`` of its own.

    Numbering the lines that repeat reads the files more than once; without the id they are read once.
    """
    lines = spark.read.text(path)
    keep = []
    if with_row_id:
        lines = with_unique_row_key(lines, F.col("_metadata.file_path"))
        keep = ["row_id"]
    return parse_graph(lines, keep=keep)


def read_series(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``yyyyMMdd,value`` text -> ``(day DATE, value DOUBLE)``; bad values -> null."""
    raw = (spark.read.schema(S.SERIES_SCHEMA).option("sep", ",").option("header", "false")
           .option("mode", "PERMISSIVE").csv(path))
    return raw.select(to_date(F.col("day")).alias("day"), to_double(F.col("value")).alias("value"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles written by ``write_articles``: ``(cameo, title, content)``."""
    return spark.read.schema(S.ARTICLE_SCHEMA).parquet(path)


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of a JSON-string column from all its rows: Spark's own inference, one distributed pass.

    Only the merged schema comes to the driver.
    """
    spark = df.sparkSession
    text = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value"))
    lines = getattr(text._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(lines).schema().json()))


def json_records(df: DataFrame, column: str, schema: T.StructType | str | None = None,
                 sample: str | None = None) -> DataFrame:
    """Parse a JSON-string column into a struct column named ``column``.

    With no schema, one is inferred from ``sample`` (a representative JSON
    text) or, without that either, from the data (``infer_json_schema``, a pass of
    its own); pass a schema for production.
    """
    if schema is None:
        schema = F.schema_of_json(F.lit(sample)) if sample is not None else infer_json_schema(df, column)
    return df.withColumn(column, F.from_json(F.col(column), schema))
