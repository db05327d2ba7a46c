"""Parquet scans with schema-drift repair.

Monthly files of the same dataset disagree on physical types (an int32 column
in one month is int64 or double in the next).  A single scan over all files
fails in the vectorised reader and ``mergeSchema`` rejects int/double pairs, so
files are grouped by their footer schema, each group is scanned *once* (one
relation per distinct schema, not per file), cast to the canonical types and
the groups are unioned by name.  The plan therefore grows with the number of
distinct schemas, not with the number of files, and so does the number of jobs:
one census job reads all footers.
"""
from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import within
from ..session import configure
from ..specs import TripSpec


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def list_parquet_files(spark: SparkSession, path: str) -> list[str]:
    """Sorted Parquet files of ``path``: itself if it is a file, else the
    ``*.parquet`` files in it and the part files of its ``*.parquet`` folders.
    A folder that holds neither but plain sub-folders (months, partitions) is
    one dataset: all files below count.

    Listing goes through the Hadoop file system of the session, so it works on
    HDFS and object stores as well as on local disks.  A folder that mixes
    ``*.parquet`` entries with other sub-folders that hold Parquet files is
    ambiguous and an error: nothing is left out silently.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(f"no such path: {path}")
    status = fs.getFileStatus(hpath)
    if status.isFile():
        return [status.getPath().toString()]

    def below(folder) -> list[str]:
        found, entries = [], fs.listFiles(folder, True)
        top = len(folder.toString().rstrip("/")) + 1
        while entries.hasNext():
            name = entries.next().getPath().toString()
            if name.endswith(".parquet") and not any(_hidden(part) for part in name[top:].split("/")):
                found.append(name)
        return found

    named, plain = [], []
    for s in fs.listStatus(hpath):
        entry = s.getPath()
        if _hidden(entry.getName()):
            continue
        if entry.getName().endswith(".parquet"):
            named += below(entry) if s.isDirectory() else [entry.toString()]
        elif s.isDirectory():
            plain += below(entry)
    if named and plain:
        raise ValueError(f"{path} holds Parquet files both as *.parquet entries and in other sub-folders "
                         f"(such as {plain[0]}); name one of them")
    if not named and not plain:
        raise FileNotFoundError(f"no Parquet files under {path}")
    return sorted(named or plain)


#: Readers at the same time where Spark itself must read the schemas.
SCHEMA_THREADS = 16


def _footer_schemas(ntz: bool):
    """Map function: per distinct schema of the task's files, their numbers.

    The schema is the one that Spark's reader infers: the row metadata that
    Spark wrote, else the types of flat columns.  NULL stands for files that
    only Spark can judge (nested or unusual types, stores without a client here).
    """
    def run(batches):
        import json

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        flat = {"BOOLEAN": "boolean", "INT32": "integer", "INT64": "long", "INT96": "timestamp", "FLOAT": "float",
                "DOUBLE": "double", "BYTE_ARRAY": "binary"}

        def spark_type(column):
            if column.max_repetition_level or "." in column.path:
                return None
            kind = json.loads(column.logical_type.to_json())
            name = kind["Type"]
            if name in ("None", "Undefined", "Unknown"):
                return flat.get(column.physical_type) if column.converted_type == "NONE" else None
            if name in ("String", "Enum", "JSON"):
                return "string"
            if name == "Date":
                return "date"
            if name == "Int":
                signed = {8: "byte", 16: "short", 32: "integer", 64: "long"}
                return signed.get(kind["bitWidth"]) if kind["isSigned"] else None
            if name == "Decimal" and column.physical_type in ("INT32", "INT64"):
                return f"decimal({column.precision},{column.scale})"
            if name == "Timestamp" and kind["timeUnit"] in ("milliseconds", "microseconds"):
                return "timestamp" if kind["isAdjustedToUTC"] or not ntz else "timestamp_ntz"
            return None

        def schema_of(path):
            scheme, _, rest = path.partition(":")
            if rest and "/" not in scheme:
                path = f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest if rest.startswith('//') else '//' + rest}"
            try:
                store, where = fs.FileSystem.from_uri(path)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                return None
            with store.open_input_file(where) as f:
                footer = pq.read_metadata(f)
            written = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            if written is not None:
                return json.dumps(json.loads(written), sort_keys=True)
            columns = [footer.schema.column(i) for i in range(footer.num_columns)]
            types = [spark_type(c) for c in columns]
            if None in types:
                return None
            return json.dumps({"type": "struct", "fields": [
                {"name": c.name, "type": t, "nullable": True, "metadata": {}} for c, t in zip(columns, types)]}, sort_keys=True)

        found: dict = {}
        for batch in batches:
            for number, path in zip(batch["number"].to_pylist(), batch["path"].to_pylist()):
                found.setdefault(schema_of(path), []).append(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.list_(pa.int64()))], ["schema", "numbers"])

    return run


def group_by_schema(spark: SparkSession, files: Iterable[str]) -> "OrderedDict[str, list[str]]":
    """Group files by their schema (the JSON that Spark's reader would infer),
    whatever their number.

    One Spark job reads the footers: each task merges its files into one row
    per distinct schema, so rows come back per task and schema, not per file.
    Files that only Spark can judge are read by Spark's own inference, a short
    job each.  Store the result (:func:`write_manifest`) to skip the census.
    """
    files = list(files)
    numbered = spark.createDataFrame(list(enumerate(files)), "number long, path string")  # a task per core
    ntz = (spark.conf.get("spark.sql.parquet.inferTimestampNTZ.enabled", "true") or "true").lower() == "true"
    rows = numbered.mapInArrow(_footer_schemas(ntz), "schema string, numbers array<long>").collect() if files else []
    known = {n: r["schema"] for r in rows for n in r["numbers"] if r["schema"] is not None}
    rest = [n for n in range(len(files)) if n not in known]
    with ThreadPoolExecutor(SCHEMA_THREADS) as pool:
        known |= zip(rest, pool.map(lambda n: json.dumps(json.loads(spark.read.parquet(files[n]).schema.json()), sort_keys=True), rest))
    groups: "OrderedDict[str, list[str]]" = OrderedDict()
    for n, f in enumerate(files):
        groups.setdefault(known[n], []).append(f)
    return groups


def group_schema(spark: SparkSession, key: str, files: Sequence[str]) -> StructType:
    """The schema of a group: its key, or (any other key) that of its first file."""
    try:
        return StructType.fromJson(json.loads(key))
    except (ValueError, KeyError, TypeError):
        return spark.read.parquet(files[0]).schema


def normalise(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast every canonical column to its type and drop the rest.

    Lookup is case-insensitive (Spark's resolver), so a month that spells a
    column differently still resolves.  A missing column is an analysis error.
    ``safe=True`` uses ``try_cast``: a value that does not fit the canonical
    type becomes NULL (and is then dropped by the range rules) instead of
    failing the job under ANSI mode.
    """
    if safe:
        return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def read_one(spark: SparkSession, path: str | list[str], types: Mapping[str, str],
             prefilter: Column | None = None, safe: bool = False, schema: StructType | None = None) -> DataFrame:
    """Scan one file (or one same-schema file group) and normalise it.
    A given ``schema`` saves the job that would infer it."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = (spark.read if schema is None else spark.read.schema(schema)).parquet(*paths)
    if prefilter is not None:
        raw = raw.where(prefilter)
    return normalise(raw, types, safe)


def write_manifest(spark: SparkSession, groups: Mapping[str, list[str]], path: str) -> str:
    """Store a schema-group manifest (schema_key, path) as a Parquet table.

    A later :func:`load_trips` call with ``manifest=read_manifest(...)`` skips
    the footer pass entirely; append new months' groups as they land.
    """
    rows = [(k, f) for k, files in groups.items() for f in files]
    spark.createDataFrame(rows, "schema_key string, path string").write.mode("overwrite").parquet(path)
    return path


def read_manifest(spark: SparkSession, path: str) -> "OrderedDict[str, list[str]]":
    """The stored groups: (schema, path) rows streamed in order, one per file."""
    groups: "OrderedDict[str, list[str]]" = OrderedDict()
    for row in spark.read.parquet(path).orderBy("path").toLocalIterator():
        groups.setdefault(row["schema_key"], []).append(row["path"])
    return groups


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Fold ``unionByName`` over frames; duplicates kept, unequal columns fail."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, frames)


#: Physical types whose comparison gives the same rows before and after a cast
#: to the canonical type: the cast widens, keeps every value and keeps order.
_LOSSLESS = {
    "int": {"tinyint", "smallint", "int"},
    "bigint": {"tinyint", "smallint", "int", "bigint"},
    "double": {"tinyint", "smallint", "int", "float", "double"},
}


def physical_prefilter(schema: StructType, spec: TripSpec) -> Column | None:
    """Cleaning predicates on the *physical* columns of one schema group.

    After a type-changing cast Catalyst can only push ``IsNotNull`` into the
    scan; comparing in the physical type lets Parquet skip row groups by
    statistics.  A rule is emitted only where the cast to the canonical type
    keeps every value and its order; columns of other types (a double read as
    int, a string) get no predicate, so the cleaned result never changes.
    """
    physical = {f.name.lower(): f for f in schema.fields}

    def exact(name: str) -> Column | None:
        field = physical.get(name.lower())
        if field is None or field.dataType.simpleString() not in _LOSSLESS.get(spec.types.get(name, ""), ()):
            return None
        return F.col(f"`{field.name}`")

    rules = []
    pay = exact(spec.payment)
    if pay is not None:
        rules.append(pay == spec.card_payment)
    for name, bound in ((spec.fare, spec.fare_bounds), (spec.distance, spec.distance_bounds), (spec.passengers, spec.passenger_bounds)):
        column = exact(name)
        if column is not None:
            rules.append(within(column, bound))
    return reduce(lambda a, b: a & b, rules) if rules else None


def load_trips(
    spark: SparkSession,
    path: str,
    spec: TripSpec | None = None,
    manifest: Mapping[str, list[str]] | None = None,
    prefilter: bool = False,
    safe: bool = False,
) -> DataFrame:
    """Read every Parquet file under ``path`` as one canonical DataFrame (S3).

    ``manifest`` maps a schema (or any key) to a list of files known to share
    it; it skips the footer census.  ``prefilter=True`` pushes the spec's plain range
    rules into each group's scan (use it when the result is cleaned anyway).
    Wall-clock columns are cast in UTC, whatever the caller's time zone was,
    so hours and weekdays are those written in the files.
    """
    configure(spark)  # before any cast of a wall-clock time is planned
    spec = spec or TripSpec()
    groups = manifest if manifest is not None else group_by_schema(spark, list_parquet_files(spark, path))
    frames = []
    for key, files in groups.items():
        schema = group_schema(spark, key, files)
        frames.append(read_one(spark, files, spec.types, physical_prefilter(schema, spec) if prefilter else None, safe, schema))
    return union_by_name(frames)
