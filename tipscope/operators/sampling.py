"""Sampling and splitting.

``bernoulli_sample`` / ``random_split`` are Spark's seeded samplers; their
result depends on the partition layout.  ``hash_sample`` / ``hash_split`` pick
rows by the md5 hash of a key, so the same rows are chosen for any layout,
cluster size or retry, and other engines can reproduce the choice.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import HASH_RANGE, hash_bucket, hash_position

#: Number of display buckets of :func:`with_hash_bucket`; samples and splits use the whole hash range.
HASH_MODULUS = 10000


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Rows kept independently with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=float(fraction), seed=seed)


def target_fraction(n_rows: int, target_rows: int) -> float:
    """R2: the sampling fraction for about ``target_rows`` rows, capped at 1."""
    return 1.0 if n_rows <= 0 else min(1.0, target_rows / n_rows)


#: Bits of a hash position decided by one counting pass.
RADIX_BITS = 15


def smallest_positions(positions: DataFrame, k: int) -> tuple[int, int]:
    """The k-th smallest value of the column ``position`` (60 bits) and how many
    rows below or at it belong to the k smallest.

    Radix counting: each of four passes counts rows by the next 15 bits among
    those that share the bits decided so far, so at most 2 ** 15 counts come
    back, whatever the number of rows; nothing is sorted.
    """
    prefix, left, bits = 0, k, 60
    while bits:
        bits -= RADIX_BITS
        digit = F.shiftright("position", bits).bitwiseAND((1 << RADIX_BITS) - 1)
        rows = positions.where(F.shiftright("position", bits + RADIX_BITS) == F.lit(prefix)) if prefix or bits + RADIX_BITS < 60 else positions
        for value, n in sorted((r["digit"], r["n"]) for r in rows.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()):
            if n >= left:
                break
            left -= n
        prefix = (prefix << RADIX_BITS) | value
    return prefix, left


def target_row_sample(df: DataFrame, target_rows: int, seed: int = 42,
                      n_rows: int | None = None, key: str | None = None) -> DataFrame:
    """R2: a sample of ``target_rows`` rows (all of them, if there are no more).

    With ``key`` it is exact and independent of layout and cluster: the rows
    with the smallest key hashes.  Rows that tie at the last hash (repeated
    keys) are told apart by the hash of all their columns, and wholly equal
    rows are taken up to the number wanted.  Without a key it is a Bernoulli
    sample, whose size is approximate.
    """
    n = df.count() if n_rows is None else n_rows
    f = target_fraction(n, target_rows)
    if f >= 1.0:
        return df
    if key is None:
        return bernoulli_sample(df, f, seed)
    if target_rows <= 0:
        return df.limit(0)

    def smallest(rows: DataFrame, position: Column, k: int) -> tuple[DataFrame, DataFrame, int]:
        """Rows surely taken, rows that tie at the last position, and how many of these are wanted."""
        last, wanted = smallest_positions(rows.select(position.alias("position")), k)
        return rows.where(position < F.lit(last)), rows.where(position == F.lit(last)), wanted

    taken, tied, wanted = smallest(df, hash_position(F.coalesce(F.col(key).cast("string"), F.lit(""))), target_rows)
    if tied.count() == wanted:
        return taken.unionByName(tied)
    whole = hash_position(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    more, equal, wanted = smallest(tied, whole, wanted)
    return taken.unionByName(more).unionByName(equal.limit(wanted))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Seeded random split (layout dependent; cache the input first)."""
    return df.randomSplit(list(weights), seed=seed)


def with_hash_bucket(df: DataFrame, key: str, modulus: int = HASH_MODULUS, out: str = "hash_bucket",
                     salt: str = "") -> DataFrame:
    return df.withColumn(out, hash_bucket(key, modulus, salt))


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """The rows whose key hash lies in the first ``fraction`` of its 60-bit range.

    Samples of one salt are nested; a positive fraction too small for the
    range is an error, never an empty sample.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    cut = int(fraction * HASH_RANGE)
    if fraction > 0 and cut == 0:
        raise ValueError(f"fraction {fraction} is below the resolution of the key hash")
    return df.where(hash_position(key, salt) < F.lit(cut))


def _edges(weights: Sequence[float]) -> list[int]:
    total, acc, edges = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        acc += w
        edges.append(int(acc / total * HASH_RANGE))
    return [0, *edges, HASH_RANGE]


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), salt: str = "") -> list[DataFrame]:
    """Disjoint, complete split by key hash ranges proportional to ``weights``.

    Use a ``salt`` when ``df`` is itself a hash sample of the same key, or the
    parts would only see the sampled range.
    """
    edges = _edges(weights)
    position = hash_position(key, salt)
    return [df.where((position >= F.lit(lo)) & (position < F.lit(hi))) for lo, hi in zip(edges[:-1], edges[1:])]


def split_labels(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2),
                 names: Sequence[str] = ("train", "test"), salt: str = "") -> DataFrame:
    """R4 as one column: the part name of every row (no row is dropped)."""
    position = hash_position(key, salt)
    part = F.lit(names[-1])
    for hi, name in reversed(list(zip(_edges(weights)[1:-1], names))):
        part = F.when(position < F.lit(hi), F.lit(name)).otherwise(part)
    return df.withColumn("part", part)
