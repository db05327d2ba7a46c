"""Samplers and splits: binomial size bounds, disjoint/complete hash splits, layout independence."""
import math

import pytest

from tipscope.operators import sampling as SM
from tipscope.sources import adapters as A

from conftest import SF01


def test_bernoulli_size_within_binomial_bounds(spark):
    li = A.table(spark, SF01, "lineitem")
    n = li.count()
    k = SM.bernoulli_sample(li, 0.1, seed=3).count()
    sd = math.sqrt(n * 0.1 * 0.9)
    assert abs(k - n * 0.1) < 5 * sd


def test_target_row_sample_caps_at_one(spark):
    df = spark.range(100)
    assert SM.target_fraction(100, 1000) == 1.0
    assert SM.target_row_sample(df, 1000).count() == 100


def test_random_split_disjoint_and_complete(spark):
    df = spark.range(2000).cache()
    a, b = SM.random_split(df, (0.8, 0.2), seed=5)
    assert a.count() + b.count() == 2000
    assert a.join(b, "id").count() == 0


def test_hash_split_disjoint_complete_and_layout_independent(spark):
    ev = A.events(spark, SF01)
    parts = SM.hash_split(ev, "event_id", (0.8, 0.2))
    ids = [set(r[0] for r in p.select("event_id").collect()) for p in parts]
    assert not (ids[0] & ids[1]) and len(ids[0] | ids[1]) == ev.count()
    again = SM.hash_split(ev.repartition(7), "event_id", (0.8, 0.2))
    assert set(r[0] for r in again[1].select("event_id").collect()) == ids[1]
    labelled = SM.split_labels(ev, "event_id")
    assert labelled.where("part = 'test'").count() == len(ids[1])


def test_hash_sample_is_nested(spark):
    ev = A.events(spark, SF01)
    small = set(r[0] for r in SM.hash_sample(ev, "event_id", 0.1).select("event_id").collect())
    big = set(r[0] for r in SM.hash_sample(ev, "event_id", 0.3).select("event_id").collect())
    assert small <= big and len(small) < len(big)


def test_salted_split_of_a_hash_sample_is_not_empty(spark):
    ev = A.events(spark, SF01)
    sample = SM.hash_sample(ev, "event_id", 0.5)
    plain = SM.hash_split(sample, "event_id", (0.8, 0.2))
    assert plain[1].count() == 0  # same buckets: the sample never reaches the test range
    salted = SM.hash_split(sample, "event_id", (0.8, 0.2), salt="split")
    n = sample.count()
    assert salted[0].count() + salted[1].count() == n and 0.1 * n < salted[1].count() < 0.3 * n


def test_xxhash_buckets_are_in_range_and_deterministic(spark):
    from pyspark.sql import functions as F
    from tipscope.functions.columns import hash_bucket

    ev = A.events(spark, SF01)
    a = ev.select("event_id", hash_bucket("event_id", 100, method="xxhash64").alias("b"))
    b = ev.repartition(5).select("event_id", hash_bucket("event_id", 100, method="xxhash64").alias("b"))
    assert a.agg(F.min("b"), F.max("b")).first() == (0, 99)
    assert a.exceptAll(b).count() == 0


def test_tiny_fractions_keep_their_share(spark):
    keys = spark.range(2_000_000)
    assert 15 <= SM.hash_sample(keys, "id", 2e-5).count() <= 75  # 40 expected
    assert 220 <= SM.hash_sample(keys, "id", 1.4e-4).count() <= 340  # 280 expected
    with pytest.raises(ValueError):
        SM.hash_sample(keys, "id", 1e-19)
