"""MLlib feature recipe.

String indexing (frequency-descending, ties alphabetical, unseen/NULL kept in
an extra bucket), one-hot encoding (last slot dropped, so the "keep" bucket is
the zero vector) and vector assembly that skips rows with a NULL/NaN input.
"""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import TripSpec


def indexers(spec: TripSpec | None = None) -> list[StringIndexer]:
    """One multi-column indexer: every categorical column is counted in the same pass."""
    s = spec or TripSpec()
    cols = list(s.categorical_features)
    return [StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], handleInvalid="keep")]


def encoders(spec: TripSpec | None = None) -> list[OneHotEncoder]:
    s = spec or TripSpec()
    cols = list(s.categorical_features)
    return [OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols])]


def assembler(spec: TripSpec | None = None, output_col: str = "features") -> VectorAssembler:
    s = spec or TripSpec()
    return VectorAssembler(
        inputCols=list(s.numeric_features) + [f"{c}_ohe" for c in s.categorical_features],
        outputCol=output_col,
        handleInvalid="skip",
    )


def build_feature_pipeline(spec: TripSpec | None = None) -> Pipeline:
    """L4: the unfitted recipe (indexers -> encoders -> assembler)."""
    return Pipeline(stages=[*indexers(spec), *encoders(spec), assembler(spec)])


def model_columns(featurised: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Keep only the columns a learner needs."""
    s = spec or TripSpec()
    cols = ["features", s.label_col]
    if s.weight_col in featurised.columns:
        cols.append(s.weight_col)
    return featurised.select(*cols)


# --- inspection helpers used by the oracle-checked queries ------------------

def _long(df: DataFrame, columns: list[str], extra: dict[str, str]) -> DataFrame:
    """Unpivot per-column outputs into (feature, value, <extra...>) rows with ``stack``."""
    parts = []
    for c in columns:
        vals = ", ".join(f"`{src.format(c=c)}`" for src in extra.values())
        parts.append(f"'{c}', CAST(`{c}` AS STRING), {vals}")
    names = ", ".join(["feature", "value", *extra.keys()])
    return df.selectExpr(f"stack({len(columns)}, {', '.join(parts)}) AS ({names})")


def index_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """L1 as data: (feature, value, idx, n_rows) for every distinct value of each column.

    One indexer is fitted for all columns (one counting pass) and then applied;
    the table is a distributed aggregate of the transformed columns, not the
    label lists on the driver.  Values appear as the indexer's strings.
    """
    idx = StringIndexer(inputCols=columns, outputCols=[f"{c}__idx" for c in columns],
                        handleInvalid="keep").fit(df)
    out = _long(idx.transform(df.select(*columns)), columns, {"idx": "{c}__idx"})
    return (out.groupBy("feature", "value", F.col("idx").cast("int").alias("idx"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def one_hot_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """L2 as data: (feature, value, vec_size, hot_slot, n_rows); hot_slot -1 = zero vector."""
    idx_cols = [f"{c}__idx" for c in columns]
    ohe_cols = [f"{c}__ohe" for c in columns]
    idx = StringIndexer(inputCols=columns, outputCols=idx_cols, handleInvalid="keep").fit(df)
    indexed = idx.transform(df.select(*columns))
    enc = OneHotEncoder(inputCols=idx_cols, outputCols=ohe_cols).fit(indexed).transform(indexed)
    enc = enc.select(*columns, *[vector_to_array(o).alias(o) for o in ohe_cols])
    enc = enc.select(*columns, *[F.size(o).alias(f"{o}_size") for o in ohe_cols],
                     *[(F.array_position(o, F.lit(1.0)) - 1).cast("int").alias(f"{o}_hot") for o in ohe_cols])
    out = _long(enc, columns, {"vec_size": "{c}__ohe_size", "hot_slot": "{c}__ohe_hot"})
    return out.groupBy("feature", "value", "vec_size", "hot_slot").agg(F.count(F.lit(1)).alias("n_rows"))
