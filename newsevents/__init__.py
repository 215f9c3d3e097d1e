"""newsevents: Spark-native analytics over daily world-news event feeds.

Everything here is DataFrame / Spark SQL / pyspark.ml code. The package is
organised by role:

* ``sources``   – readers for the event feed, knowledge-graph feed, daily
  series, articles and JSON records (plus feed lines built from tables).
* ``sinks``     – writers for the job outputs.
* ``functions`` – column-expression helpers (typed conversions, text).
* ``operators`` – the analytics: record parsing, pair averages, trailing
  windows, entity ranking, article extraction, TF-IDF, clustering.
* ``plans``     – the chained jobs and the registered query catalogue.
* ``streaming`` – the same feed parsing driven by Structured Streaming.
"""

from newsevents.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
