"""A long daily trend kept up to date.

Two Parquet tables, partitioned by year and month: ``daily`` (keys, day, value) and
``trend`` (keys, day, value, trend). An increment brings whole days, new ones or corrected ones. It
replaces those days in ``daily``, and in ``trend`` it computes anew only the days whose frame
holds one of them: the day itself and the ``n - 1`` days after it. Both are written with dynamic partition
overwrite, so a month that no changed day touches is neither read nor written.

An increment can be applied again: after a failure between or in the two writes, the same call
leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.operators.trend import _check_window, moving_average
from newsevents.session import cut_lineage


def _months(days: Iterable[date]) -> list[int]:
    return sorted({d.year * 100 + d.month for d in days})


def _in_months(months: list[int]) -> Column:
    """A condition on the partition columns alone: other months are not opened."""
    return (F.col("year") * 100 + F.col("month")).isin(months) if months else F.lit(False)


class TrendStore:
    """The tables under ``path``, for a trailing window of ``n`` days."""

    def __init__(self, spark: SparkSession, path: str, n: int, keys: Sequence[str] = (), key_types: str = "", value: str = "value"):
        """``key_types`` are the keys' columns as a DDL string, in the order of ``keys``."""
        _check_window(n)
        self.spark, self.path, self.n, self.keys, self.value = spark, path, n, list(keys), value
        self.columns = [*self.keys, "day", value]
        head = f"{key_types}, " if key_types else ""
        self.schemas = {"daily": f"{head}day date, {value} double, year int, month int",
                        "trend": f"{head}day date, {value} double, trend double, year int, month int"}

    def _hadoop(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def table(self, name: str, months: list[int] | None = None) -> DataFrame:
        """``daily`` or ``trend``, whole or some months of it."""
        fs, p = self._hadoop(name)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.schemas[name])
        df = self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")
        return df if months is None else df.where(_in_months(months))

    def trend(self) -> DataFrame:
        """``keys, day, value, trend`` of all days."""
        return self.table("trend").select(*self.columns, "trend")

    def _replace(self, name: str, rows: DataFrame, months: list[int]) -> None:
        """Write the rows of whole months; a month that has none left is removed."""
        rows = cut_lineage(rows.withColumn("year", F.year("day")).withColumn("month", F.month("day")), f"{name}-months")
        (rows.repartition("year", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month").parquet(f"{self.path}/{name}"))
        left = {r.year * 100 + r.month for r in rows.select("year", "month").distinct().toLocalIterator()}
        for m in set(months) - left:
            fs, p = self._hadoop(name, f"year={m // 100}", f"month={m % 100}")
            fs.delete(p, True)

    def update(self, daily: DataFrame, days: Iterable[date] = ()) -> list[date]:
        """Take in whole days and return all that were touched.

        ``daily`` has ``keys, day, value``, a row for each series and day. ``days`` names further days that the increment
        speaks for: one without rows in ``daily`` is deleted. Rows without a day are left out.
        """
        rows = cut_lineage(daily.select(*[F.col(c) for c in self.columns]).where(F.col("day").isNotNull()), "increment")
        touched = sorted({*days, *(r.day for r in rows.select("day").distinct().toLocalIterator())})    # days, not events
        if not touched:
            return []
        one = timedelta(days=1)
        changed = self.spark.createDataFrame([(d,) for d in touched], "day date")
        months = _months(touched)
        kept = self.table("daily", months).select(*self.columns).join(changed, "day", "left_anti").select(*self.columns)
        self._replace("daily", kept.unionByName(rows), months)

        due = sorted({d + i * one for d in touched for i in range(self.n)})
        wanted = self.spark.createDataFrame([(d,) for d in due], "day date")
        read = _months({d - i * one for d in (*touched, *due) for i in range(0, self.n)})
        fresh = moving_average(self.table("daily", read).select(*self.columns), self.n, keys=self.keys, value=self.value, out="trend")
        fresh = fresh.join(wanted, "day", "left_semi").select(*self.columns, "trend")
        months = _months(due)
        kept = self.table("trend", months).select(*self.columns, "trend").join(wanted, "day", "left_anti").select(*self.columns, "trend")
        self._replace("trend", kept.unionByName(fresh), months)
        return touched
