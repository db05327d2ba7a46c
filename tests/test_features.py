"""Feature recipe: indexer order and ties, keep bucket, one-hot width, assembler skip."""
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tipscope.operators import features as FE
from tipscope.specs import TripSpec


def test_indexer_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",), ("c",), ("c",)], "v string")
    t = {r["value"]: r["idx"] for r in FE.index_table(df, ["v"]).collect()}
    assert t == {"c": 0, "a": 1, "b": 2}


def test_numeric_categories_are_stringified(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "v double")
    t = {r["value"]: r["idx"] for r in FE.index_table(df, ["v"]).collect()}
    assert t == {"2.0": 0, "1.0": 1}


def test_unseen_and_null_encode_to_zero_vector(spark):
    spec = TripSpec(numeric_features=("x",), categorical_features=("c",))
    fit = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "x double, c string")
    model = FE.build_feature_pipeline(spec).fit(fit)
    test = spark.createDataFrame([(1.0, "a"), (1.0, "z"), (1.0, None)], "x double, c string")
    out = [r["f"] for r in model.transform(test).select(vector_to_array("features").alias("f")).collect()]
    assert [len(v) for v in out] == [3, 3, 3]  # 1 numeric + 2 seen labels (keep slot dropped)
    assert out[0] == [1.0, 1.0, 0.0] and out[1] == [1.0, 0.0, 0.0] and out[2] == [1.0, 0.0, 0.0]


def test_assembler_skips_null_numeric(spark):
    spec = TripSpec(numeric_features=("x",), categorical_features=("c",))
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (float("nan"), "b")], "x double, c string")
    out = FE.build_feature_pipeline(spec).fit(df).transform(df)
    assert out.count() == 1


def test_one_hot_table_widths(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    rows = {r["value"]: (r["vec_size"], r["hot_slot"]) for r in FE.one_hot_table(df, ["v"]).collect()}
    assert rows == {"b": (2, 0), "a": (2, 1)}
