"""Sinks (S5-S10): feature sets, reuse-if-present materialisation and metrics tables.

Results are written by Spark as tables (Parquet), not as JSON files on the
driver's disk, so they survive driver loss and can be added to by many
submissions (one row per model / per scaling run).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished Spark write (``_SUCCESS`` marker)."""
    fs, hpath = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(hpath, "_SUCCESS")))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Write a frame (vector columns included) as Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_trips_by_month(df: DataFrame, path: str, ts_col: str = "tpep_pickup_datetime",
                         mode: str = "overwrite") -> str:
    """Write normalised trips partitioned by ``yyyy-MM`` of the pickup time.

    Later reads that filter on ``month`` prune whole folders (``PartitionFilters``
    in the scan), and a new month lands as a new folder.  Rows are only sorted
    by month *within* each task (no shuffle): a month holding a third of the
    rows is still written by many tasks, and since the sources are monthly
    files each task sees few months, so it writes few files.
    """
    out = df.withColumn("month", F.date_format(F.col(ts_col), "yyyy-MM"))
    out.sortWithinPartitions("month").write.mode(mode).partitionBy("month").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a written frame back (vector columns keep their type)."""
    return spark.read.parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a written frame that no later step reads; nothing if there is none."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def commit_folder(spark: SparkSession, aside: str, path: str) -> bool:
    """Give a finished folder its final name in one rename; False if another
    writer was first (the folder is then deleted).

    The rename fails if the name is taken, so of several writers one wins and
    readers see no table or a whole one.  What an interrupted writer without
    this protocol left under the name (no ``_SUCCESS``) is moved out of the way.
    """
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    source = jvm.org.apache.hadoop.fs.Path(aside)
    names = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def rename(a, b) -> bool:
        try:
            names.rename(fs.makeQualified(a), fs.makeQualified(b), never_overwrite)
            return True
        except Py4JJavaError:
            if fs.exists(b):
                return False
            raise

    if fs.exists(target) and not is_complete(spark, path):
        rename(target, jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.stale-{new_run_id()}"))
    if rename(source, target):
        return True
    fs.delete(source, True)
    return False


def materialise_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse ``path`` if a complete write exists there, else build and write it.

    The table is written aside and committed by one rename, so two submissions
    that build at the same time leave one complete table.  Key the path by
    *every* input that changes the content (row target, seed, source); a path
    keyed by one of them would silently reuse stale data.
    """
    if not is_complete(spark, path):
        commit_folder(spark, write_parquet(build(), f"{path.rstrip('/')}.building-{new_run_id()}"), path)
    return read_parquet(spark, path)


def sample_path(base: str, **key) -> str:
    """A path under ``base`` keyed by all the given parameters, e.g. rows and seed."""
    suffix = "_".join(f"{k}={key[k]}" for k in sorted(key))
    return f"{base.rstrip('/')}/{suffix}"


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def append_metrics(df: DataFrame, path: str, run_id: str, kind: str, entry: str = "all") -> DataFrame:
    """Add result rows to the metrics table of one kind, keyed by run id.

    Each kind (models, data_scaling, parallelism, balance, ...) has its own
    schema and its own folder under ``path``; rows from many runs accumulate.
    The call is idempotent: the rows of one (run, ``entry``) are one partition,
    which a repeated call replaces (dynamic partition overwrite).
    """
    out = df.withColumn("run_id", F.lit(run_id)).withColumn("written_at", F.current_timestamp())
    keyed = out.withColumns({"stored_run": F.lit(f"run-{run_id}"), "stored_entry": F.lit(f"entry-{entry}")})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stored_run", "stored_entry").parquet(
        f"{path.rstrip('/')}/{kind}")
    return out


def read_metrics(spark: SparkSession, path: str, kind: str, run_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{path.rstrip('/')}/{kind}")
    if run_id is not None:
        df = df.where(F.col("stored_run") == f"run-{run_id}")  # reads that run's folders only
    return df.drop("stored_run", "stored_entry")


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 5) -> DataFrame:
    """The first ``n`` rows of a few columns (a limit is the feature here)."""
    return (df.select(*columns) if columns else df).limit(n)
