"""Writers for the job outputs (K1-K6). All are plain DataFrame writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsevents.operators.checks import SameCount
from newsevents.operators.records import null_empty_structs


def _field(name: str) -> Column:
    """A value as text: null is empty, a tab or line break in it becomes a blank (the format has no quoting)."""
    return F.coalesce(F.regexp_replace(F.col(name).cast("string"), r"[\t\r\n]", " "), F.lit(""))


def tsv_line(columns: list[str]) -> Column:
    return F.concat_ws("\t", *[_field(c) for c in columns]).alias("value")


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text, no header (K1, K6); blanks around a value are kept."""
    df.select(tsv_line(df.columns)).write.mode(mode).text(path)


def write_series(df: DataFrame, path: str, day: str = "day", value: str = "value",
                 mode: str = "overwrite", check: SameCount | None = None) -> None:
    """``yyyyMMdd,value`` lines in day order (K3); readable by ``read_series``. ``check`` counts the rows as they are written."""
    ordered = df.select(F.date_format(day, "yyyyMMdd").alias("day"), F.col(value).cast("string").alias("value")).orderBy("day")
    if check is not None:
        ordered = check.after(ordered)
    ordered.write.mode(mode).option("header", "false").csv(path)


def write_ranked(counts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``entity \\t n`` per kind, files in rank order, one pass (K2).

    Range partitioning on (kind, -n, entity) spreads the sort over all tasks;
    ``partitionBy('kind')`` gives the three output folders in the same write.
    """
    ordered = counts.repartitionByRange("kind", F.desc("n"), "entity").sortWithinPartitions(
        "kind", F.desc("n"), "entity")
    ordered.select("kind", tsv_line(["entity", "n"])).write.mode(mode).partitionBy("kind").text(path)


def write_articles(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(cameo, title, content)`` Parquet (K4), a null title or content as ``""``; no 64 KB limit on text."""
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("title", "content")]
    articles.select("cameo", *text).write.mode(mode).parquet(path)


def write_event_json(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Every event as ``(cameo, json)`` (K5); empty structs and null leaves left out."""
    tidy = null_empty_structs(events)
    (tidy.select("cameo", F.to_json(F.struct(*[F.col(c) for c in tidy.columns])).alias("json"))
     .write.mode(mode).option("compression", "zstd").parquet(path))      # names repeat in every row


def write_points(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``cluster \\t id`` text (K6)."""
    write_tsv(points.select("cluster", "cameo"), path, mode)
