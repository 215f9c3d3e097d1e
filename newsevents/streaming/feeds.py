"""The feeds as streams: new daily files in a folder drive the same parsers.

The reference ran one batch job per daily file. Here a folder that receives
daily feed files is a Structured Streaming file source; every micro-batch
goes through the same column expressions as the batch readers, and the
aggregates keep their running state in the state store:

* pair daily averages: state = one (sum, count) per day, so it grows with
  the number of days, not with events; output mode ``update``.
* entity counts: state = one count per (kind, entity); partial aggregation
  runs before the state shuffle as in batch.

A query that writes Parquet keeps its checkpoint beside its output
(``<path>_checkpoint``), so starting it again resumes after the last batch. Each
batch is written to a folder of its own, ``batch_id=<n>``, with overwrite: a batch
that is run again replaces its rows. A query into memory has nothing to resume
and gets a new checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsevents import schema as S
from newsevents.operators.entities import entity_counts
from newsevents.operators.pairs import pair_filter
from newsevents.operators.records import parse_event_csv_columns, parse_graph, with_row_key
from newsevents.session import shared_dir


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming event rows from feed files arriving in ``path``."""
    reader = (spark.readStream.schema(S.raw_event_schema())
              .option("sep", "\t").option("quote", "").option("escape", "")
              .option("nullValue", "").option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_event_csv_columns(reader.csv(path))


def stream_graph(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming knowledge-graph rows (with ``row_id``) from files arriving in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = with_row_key(reader.load(path), F.col("_metadata.file_path"))
    return parse_graph(lines, keep=["row_id"])


def pair_daily_avg_stream(events: DataFrame, c1: str, c2: str, measure: str = "goldstein") -> DataFrame:
    """Running ``(day, avg_<measure>, n)`` for one actor-country pair."""
    return (pair_filter(events, c1, c2).groupBy("day")
            .agg(F.avg(measure).alias(f"avg_{measure}"), F.count(measure).alias("n")))


def entity_counts_stream(graph: DataFrame) -> DataFrame:
    """Running ``(kind, entity, n)``."""
    return entity_counts(graph)


def start(df: DataFrame, name: str, sink: str = "memory", path: str | None = None,
          mode: str | None = None, checkpoint: str | None = None,
          available_now: bool = False) -> StreamingQuery:
    """Start a streaming aggregate, or go on with it after a stop.

    ``sink="memory"`` keeps the whole result as table ``name`` (mode
    ``complete``; tests, notebooks). ``sink="parquet"`` appends each batch's
    changed rows (mode ``update``) under ``path`` through ``foreachBatch``, with
    the batch id as partition column, readable while the stream runs.
    """
    spark = df.sparkSession
    if sink == "parquet" and not path:
        raise ValueError("a parquet sink needs a path")
    checkpoint = checkpoint or (path.rstrip("/") + "_checkpoint" if sink == "parquet" else shared_dir(spark, "stream", name))
    writer = df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if sink == "memory":
        return writer.outputMode(mode or "complete").format("memory").start()
    if sink == "parquet":
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

        return writer.outputMode(mode or "update").foreachBatch(write_batch).start()
    raise ValueError(f"unknown sink {sink!r}")
