"""Incremental form of the batch pipeline for trip files that keep arriving.

The reference is batch-only; this module runs the *same* operators (scan,
normalise, clean, label, month volume and class balance) as a Structured
Streaming query over a directory that receives new monthly files, so the
summaries stay current without rescanning old months.

A file stream has one read schema, so each stream covers files of one
physical layout (one schema group of :mod:`tipscope.sources.parquet`); run one
stream per group or land files through a normalising batch job first.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import prepare as P
from ..operators.explore import month_start
from ..session import checkpoint_dir
from ..sources.parquet import normalise
from ..specs import TripSpec


def trip_stream(spark: SparkSession, path: str, physical_schema: StructType,
                spec: TripSpec | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of ``path`` -> canonical types -> cleaned, labelled trips."""
    s = spec or TripSpec()
    reader = spark.readStream.schema(physical_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = normalise(reader.parquet(path), s.types)
    return P.add_label(P.clean_trips(raw, s), s)


def monthly_summary(trips: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Running (month, n_rows, n_pos, n_neg, pos_rate) over a trip stream.

    A streaming aggregate keyed by month: state holds one row per month, and
    partial counts are merged per micro-batch (no raw rows kept in state).
    """
    s = spec or TripSpec()
    lab = F.col(s.label_col)
    agg = trips.groupBy(month_start(s.pickup).alias("m")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lab == 1).alias("n_pos"),
        F.count_if(lab == 0).alias("n_neg"),
    ).select(F.date_format("m", "yyyy-MM").alias("month"), "n_rows", "n_pos", "n_neg")
    return agg.withColumn("pos_rate", F.try_divide(F.col("n_pos").cast("double"), F.col("n_pos") + F.col("n_neg")))


def start_summary(summary: DataFrame, sink_path: str, name: str = "trip_summary",
                  checkpoint: str | None = None, available_now: bool = True):
    """Run the summary to a Parquet table, rewritten from the state each batch.

    The checkpoint lives under the session's shared checkpoint folder, so the
    query restarts where it stopped after a driver or executor loss.
    """
    spark = summary.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    writer = (summary.writeStream.outputMode("complete").queryName(name)
              .option("checkpointLocation", ckpt).foreachBatch(write_batch))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
