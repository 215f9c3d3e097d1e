"""Session construction and the shared (cluster-visible) scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, AQE for partition sizing and skewed
# joins, Arrow for the one pandas UDF, no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Runtime SQL settings the operators are tuned for. The 58-column feed parse
# fuses into one generated method; past ~8 KB of bytecode the JVM will not
# JIT it, so such a stage is better run without whole-stage fusion.
RUNTIME_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set ``RUNTIME_CONF`` on a session the caller built, unless already set."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) in (None, "65535"):
            spark.conf.set(key, value)


def get_spark(app: str = "newsevents", master: str | None = None,
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings.update(RUNTIME_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (once per context).

    The one Arrow UDF (the stemmer) lives in this package; executors need it
    on their path. ``addPyFile`` serves a zip of the package from the driver,
    as ``spark-submit --py-files`` would.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_newsevents_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="newsevents-pyfiles-"), "newsevents.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._newsevents_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a private one on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share (jobs: --checkpoint-dir)")
        root = tempfile.mkdtemp(prefix="newsevents-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(path, length, time)`` of a file, or of all files of a folder, on any file system; empty if it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isDirectory():
            out += list_files(spark, st.getPath().toString())
        else:
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out)


def publish_once(spark: SparkSession, path: str, write) -> str:
    """Write a derived table under ``path`` once and return where its copy is.

    Each writer writes a version folder of its own, which counts only once
    Spark has put ``_SUCCESS`` into it: a crash leaves a version that nobody
    reads, and nothing is ever renamed over or into another writer's folder.
    Of several complete versions the first by name is read.
    """
    def complete() -> list[str]:
        return sorted(f[:-len("/_SUCCESS")] for f, _, _ in list_files(spark, path) if f.endswith("/_SUCCESS"))

    done = complete()
    if not done:
        write(f"{path}/v-{uuid.uuid4().hex[:12]}")
        done = complete()
    if not done:
        raise RuntimeError(f"nothing complete was published under {path}")
    return done[0]


def delete_scratch(spark: SparkSession) -> None:
    """Delete the folders that ``shared_dir`` handed out in this application; for the end of a job."""
    made = spark.sparkContext.__dict__.setdefault("_newsevents_scratch", [])
    while made:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir). Only when neither is set - local tests - is a private
    folder created and registered, so ``DataFrame.checkpoint()`` works too.
    """
    root = shared_root(spark)
    name = "-".join(parts + (uuid.uuid4().hex[:12],)) if parts else uuid.uuid4().hex
    path = os.path.join(root, name) if "://" not in root else root.rstrip("/") + "/" + name
    spark.sparkContext.__dict__.setdefault("_newsevents_scratch", []).append(path)
    return path


#: Spark's setting that deletes a finished query's shuffle files.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession):
    """Shuffle files of what is written inside go when it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def cut_lineage(df, name: str = "cut"):
    """Materialise ``df`` as a Parquet table in the shared folder and read it back.

    One pass over the input (an eager ``checkpoint()`` computes it twice:
    once to count, once to write), the result survives executor loss, and
    later stages see real file statistics. Used before iterative work and
    wherever non-deterministic ids must stay fixed. The shuffle files behind the table go when it is written.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with shuffles_cleaned(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._cut_path = path
    return out


def drop_cut(*tables) -> None:
    """Delete tables that ``cut_lineage`` returned and nothing reads any more."""
    for t in tables:
        path = getattr(t, "_cut_path", None)
        if path:
            sc = t.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
