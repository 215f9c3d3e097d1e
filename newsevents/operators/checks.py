"""Counts taken in the pass that does the work.

The reference counted a series before and after its window and ended the job if the
numbers differed, at the price of two more passes. ``SameCount`` has Spark's observed metrics count the
rows as they go by. A task that is run again after a lost executor may be counted twice in such
a metric, so a difference is settled by counting for real before it fails a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RowCountError(ValueError):
    """A job's output has another number of rows than its input."""


class SameCount:
    """Rows that go into a job and rows that come out of it."""

    def __init__(self):
        self._before, self._after = Observation(), Observation()
        self._input: DataFrame | None = None

    def before(self, df: DataFrame) -> DataFrame:
        """``df``, its rows counted as the job reads them."""
        self._input = df
        return df.observe(self._before, F.count(F.lit(1)).alias("n"))

    def after(self, df: DataFrame) -> DataFrame:
        """``df``, its rows counted as they are written; the last step, past any sort (a sort samples its input)."""
        return df.observe(self._after, F.count(F.lit(1)).alias("n"))

    def verify(self, written: Callable[[], int]) -> int:
        """After the action: raise unless both are equal. ``written()`` counts what was written, for the case of doubt."""
        n_in, n_out = self._before.get["n"], self._after.get["n"]
        if n_in != n_out:
            n_in, n_out = self._input.count(), written()
            if n_in != n_out:
                raise RowCountError(f"{n_in} rows in, {n_out} rows out")
        return n_out
