"""Local sessions for tests, the bench and the scripts (the library makes none)."""
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.driver.memory": "8g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(name: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session; its checkpoint folder is a new scratch folder.
    Settings are given with ``__`` for the dots of their names."""
    own = {k.replace("__", "."): str(v) for k, v in settings.items()}
    folder = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix=f"{name}-") + "/checkpoints"}
    conf = SparkConf().setMaster(f"local[{cores}]").setAppName(name).setAll((SETTINGS | folder | own).items())
    spark = SparkSession.builder.config(conf=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
