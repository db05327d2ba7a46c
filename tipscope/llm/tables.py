"""Written intermediate tables and small helpers shared by the operators."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipscope.session import checkpoint_dir

#: Broadcasting is asked for below this many bytes of proven size only.
BROADCAST_BYTES = 32 << 20

#: Bounds of an Arrow batch: setting, its usual value, and the value set here.
ARROW_BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"),)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, inside one projection."""
    return F.element_at(F.transform(F.array(value), use), 1)


class Workspace:
    """A folder of this run below the session's shared checkpoint folder.

    ``save`` writes a table and reads it back, which cuts the lineage: a lost
    executor costs a re-read of shared files, never a recomputation.  Batches
    of long texts sent to Python are kept small, unless the session says how
    large they are.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        for key, usual, value in ARROW_BATCH:
            if spark.conf.get(key, usual) == usual:
                spark.conf.set(key, value)
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Delete saved tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(conf).delete(path, True)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark a side for broadcasting if ``rows * row_bytes`` proves it small;
    beyond that the join shuffles."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
