"""Helpers shared by the operators: table access, Arrow text buffers, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from newsevents.session import ship_package, shared_dir

#: Upper bound on the bytes of text that one numpy pass works on (one document may be longer).
SLICE_BYTES = 1 << 19


def documents(spark: SparkSession, sf_dir: str, *columns: str, name: str = "documents") -> DataFrame:
    """One of the given tables, by the columns named."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Rows of an Arrow batch: a few MB of text, so that workers hold little at a time.
BATCH_ROWS = "500"


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package made importable on the executors, over small batches.

    The session's batch size is lowered if it is still Spark's default.
    """
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(fn, schema)


#: Spark's setting that deletes a finished query's shuffle files.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage ends there).

    The shuffle files behind the table are deleted once it is written, not when
    the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_written_path", None)
        if path:
            jvm = t.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets (n + 1); null counts as empty.

    Zero copy: Arrow stores a string column as one byte buffer with offsets.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if col.null_count:
        # A null row may cover bytes: give it none.
        texts = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
        return text_buffer(texts)
    return buf, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def batches(it) -> Iterator[pa.RecordBatch]:
    """Non-empty record batches."""
    for b in it:
        if b.num_rows:
            yield b
