"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver's tables (or feed lines Spark builds from them)
whole. Oracles state the expected answer straight from the tables. Computed
columns carry the same alias on both sides; floating results are rounded to
6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.session import apply_runtime_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def flatten(df: DataFrame) -> DataFrame:
    """Struct columns -> ``<struct>_<field>`` top-level columns."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"{f.name}.{g}").alias(f"{f.name}_{g}") for g in f.dataType.fieldNames()]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Importing the query modules fills the registry.
from newsevents.plans import q_articles, q_clusters, q_events, q_graph, q_io, q_text  # noqa: E402,F401,I001
