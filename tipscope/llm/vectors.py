"""Integer vectors of embedding rows, and cells in which blocks of rows meet tiles of rows."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Inner products of components up to this fit 64 bits for up to 4096 dimensions.
LARGEST = 1 << 25


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label``, ``v``: floor(scale * component) of every row that takes
    part (no NULL vector, no NULL or non-finite component)."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    checked = F.when(F.forall(whole, lambda c: F.abs(c) <= LARGEST), whole).otherwise(
        F.raise_error(F.lit(f"a vector has a component beyond {LARGEST / scale:g}: its inner products do not fit")))
    label = F.col("label").cast("long") if "label" in rows.columns else F.lit(None).cast("long")
    return rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), checked.alias("v"))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as int64, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(lengths.max(initial=0)), width or 0)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def one_chunk(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def nullable_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 in the place of NULL, and which of them are NULL."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
