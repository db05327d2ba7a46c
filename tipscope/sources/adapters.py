"""Fixture adapters: views of the local test tables in the shapes the operators expect.

* ``trips_from_lineitem`` (T1): ``lineitem`` joined to ``orders`` on the order
  key, renamed to the canonical trip schema.  Pickup/drop-off are the order and
  ship dates, so durations are measured in days (see ``specs.LINEITEM_TRIPS``).
* ``events`` (T2): time-shaped rows with every hour of the day.
* ``document_quality`` (T3): ``documents`` joined to ``labels`` with text features.
* ``lineitem_scores`` (T4): deterministic scorers over ``lineitem`` so that the
  evaluation operators can be checked exactly.
"""
from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the T1 adapter: order status -> payment type and order
# priority -> rate code ('4-NOT SPECIFIED' becomes a missing rate code).
PAYMENT_BY_STATUS = (("F", 1), ("O", 2), ("P", 3))
RATE_CODE_BY_PRIORITY = (("1-URGENT", 1.0), ("2-HIGH", 2.0), ("3-MEDIUM", 3.0), ("5-LOW", 5.0))


def _lookup(c, pairs, otherwise=None):
    expr = None
    for key, value in pairs:
        expr = (F.when(c == key, F.lit(value)) if expr is None
                else expr.when(c == key, F.lit(value)))
    return expr.otherwise(F.lit(otherwise))


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-shaped rows from ``lineitem ⋈ orders`` in the canonical schema.

    Surcharge columns carry deterministic NULLs so the fill rules have work.
    The join is a plain equi-join; Spark chooses broadcast only when the
    ``orders`` side is under ``autoBroadcastJoinThreshold`` and a shuffle join
    on ``o_orderkey`` otherwise.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    tip = F.col("l_extendedprice") * F.col("l_tax")
    extra = F.col("l_discount")
    tolls = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double")).otherwise(F.col("l_tax") * 100)
    congestion = F.when(F.col("l_linestatus") == "O", F.lit(2.5)).otherwise(F.lit(None).cast("double"))
    airport = F.when(F.col("l_returnflag") == "A", F.col("l_quantity") / 10).otherwise(F.lit(None).cast("double"))
    return j.select(
        F.col("l_orderkey").alias("trip_key"),
        F.col("l_linenumber").alias("trip_line"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        _lookup(F.col("o_orderpriority"), RATE_CODE_BY_PRIORITY).cast("double").alias("RatecodeID"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").cast("int").alias("DOLocationID"),
        _lookup(F.col("o_orderstatus"), PAYMENT_BY_STATUS).cast("int").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        extra.alias("extra"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        (F.col("l_extendedprice") + tip + extra).alias("total_amount"),
        congestion.alias("congestion_surcharge"),
        airport.alias("airport_fee"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table (timestamp ``ts``, numeric ``value``)."""
    return table(spark, sf_dir, "events")


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label and numeric text features.

    label = 1 for low quality (``quality = 0``, the minority class).  Features
    are whole-text character shares computed with built-in functions.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id", "inner")
    n = F.greatest(F.length("text"), F.lit(1))

    def count_of(chars: str):
        # characters in ``chars`` = length minus length with them deleted (no regex)
        return F.length("text") - F.length(F.translate("text", chars, ""))

    return j.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (count_of(string.digits) / n).alias("digit_share"),
        (count_of(string.ascii_uppercase) / n).alias("upper_share"),
        (count_of("\n") / n).alias("newline_share"),
        (F.size(F.split("text", "\\s+")) / n).alias("word_density"),
        F.col("lang"),
        (F.col("quality") == 0).cast("int").alias("label"),
    )


# Fixed values of the T4 scorers: name -> score expression over lineitem.  The
# label is l_tax < 0.015 and a scorer predicts 1 when its score is >= 0.5.
SCORER_LABEL_TAX = 0.015
SCORER_CUTOFF = 0.5


def scorer_columns():
    return {
        "quantity": F.col("l_quantity") / 50.0,
        "discount": F.col("l_discount") * 10.0,
        "price": F.col("l_extendedprice") / 105000.0,
        "inverse_quantity": 1.0 - F.col("l_quantity") / 50.0,
    }


def lineitem_scores(spark: SparkSession, sf_dir: str, scorer: str = "quantity") -> DataFrame:
    """T4: (label, score, prediction) from one deterministic scorer over ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    score = scorer_columns()[scorer]
    return li.select(
        (F.col("l_tax") < SCORER_LABEL_TAX).cast("int").alias("label"),
        score.alias("score"),
        (score >= SCORER_CUTOFF).cast("double").alias("prediction"),
    )


def lineitem_scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 for every scorer at once, long form (model, label, score, prediction).

    One scan of ``lineitem``; the scorers are unpivoted with ``stack`` (a narrow
    generator), so several "models" are evaluated in the same pass.
    """
    li = table(spark, sf_dir, "lineitem")
    cols = scorer_columns()
    stacked = ", ".join(f"'{name}', s_{i}" for i, name in enumerate(cols))
    wide = li.select(
        (F.col("l_tax") < SCORER_LABEL_TAX).cast("int").alias("label"),
        *[expr.alias(f"s_{i}") for i, expr in enumerate(cols.values())],
    )
    long = wide.select("label", F.expr(f"stack({len(cols)}, {stacked}) as (model, score)"))
    return long.withColumn("prediction", (F.col("score") >= SCORER_CUTOFF).cast("double"))
