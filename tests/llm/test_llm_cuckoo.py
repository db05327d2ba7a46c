import hashlib
import random

from llm_frames import make_docs
from tipscope.llm import cuckoo as C


def squeezed(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), i))
    return {(i, min(g)[1], len(g), hashlib.sha256(squeezed(t).encode()).hexdigest())
            for i, t in rows for g in [groups[squeezed(t)]]}


def cases():
    rng = random.Random(9)
    out = [None, "", " ", "\n\t", "a b", "ab", "a  b ", "AB", "é e", "ée", "x" * 30_000, "x " * 30_000]
    out += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    return out + ["hot group"] * 200


def test_groups(spark):
    rows = list(enumerate(cases()))
    got = C.duplicate_groups(make_docs(spark, [t for _, t in rows])).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == expected(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got) and len(got) == len(rows)


def test_repeated_and_null_ids(spark):
    docs = make_docs(spark, ["a", "a", "a", "b", "b", None], ids=[7, 7, None, None, None, 3])
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in C.duplicate_groups(docs).collect()]
    assert sorted(got, key=str) == sorted([(7, 7, 3, True), (7, 7, 3, False), (None, 7, 3, False), (None, None, 2, True),
                                           (None, None, 2, False), (3, 3, 1, True)], key=str)
    assert C.drop_duplicates(docs).count() == 3


def test_drop_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (2, "ab", "z", "w"), (3, "c", None, None)],
                                 "doc_id long, text string, digest string, rid string")
    out = C.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(1, "a b", "x", "y"), (3, "c", None, None)}


def test_empty(spark):
    docs = make_docs(spark, [])
    assert C.duplicate_groups(docs).count() == 0
    assert C.drop_duplicates(docs).count() == 0


def test_index_insert_lookup_delete(spark):
    first, second = make_docs(spark, ["a", "b", "b", "c"]), make_docs(spark, ["b", "d", "e e"], ids=[10, 11, 12])
    index = C.DigestIndex(spark).insert(first).insert(second)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in index.members().collect()} == {
        (0, 0, 1), (1, 1, 3), (2, 1, 3), (10, 1, 3), (3, 3, 1), (11, 11, 1), (12, 12, 1)}
    index.delete(spark.createDataFrame([(1,), (11,)], "doc_id long"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in index.members().collect()} == {
        (0, 0, 1), (2, 2, 2), (10, 2, 2), (3, 3, 1), (12, 12, 1)}
    probe = make_docs(spark, ["d", "ee", " b", "zz"])
    assert {(r.doc_id, r.found, r.keep_id) for r in index.lookup(probe).collect()} == {
        (0, False, None), (1, True, 12), (2, True, 2), (3, False, None)}


BIG = 2 ** 53 + 1


def test_ids_of_64_bits_beside_null_ids(spark):
    """Hash-like ids, some NULL: every id of a result is one of the table, and no text is lost."""
    texts = [f"text {i % 900}" for i in range(1800)]
    ids = [None if i % 11 == 0 else (2 ** 63 - 1 - i if i % 2 else BIG + 2 * i) for i in range(1800)]
    docs = make_docs(spark, texts, ids=ids)
    got = C.duplicate_groups(docs).collect()
    least = {}
    for i, t in zip(ids, texts):
        least[t] = min(least.get(t, (True, 0)), (i is None, i or 0))
    want = sorted((str(i), str(None if least[t][0] else least[t][1]), 2) for i, t in zip(ids, texts))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    kept = C.drop_duplicates(docs).collect()
    assert len(kept) == 900 and {r.text for r in kept} == set(texts) and {r.doc_id for r in kept} <= set(ids)


def test_alternating_insertions_and_deletions(spark):
    """Against a plain dictionary, with few keys to a shard so that the number of shards changes."""
    rng = random.Random(4)
    index, live, number = C.DigestIndex(spark, keys_per_shard=20, min_shards=3), {}, 0
    for step in range(5):
        ids = [BIG + 2 * (number + i) for i in range(70)]
        number += 70
        texts = [f"t {rng.randrange(60 + 40 * step)}" + " " * rng.randrange(3) for _ in ids]
        index.insert(make_docs(spark, texts, ids=ids))
        live |= dict(zip(ids, texts))
        gone = rng.sample(sorted(live), 25)
        index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
        live = {i: t for i, t in live.items() if i not in gone}
        got = {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in index.members().collect()}
        assert got == expected(list(live.items()))
        assert index.keys().count() == len({squeezed(t) for t in live.values()})
    assert index.shards > 6


def test_a_hot_digest_is_split(spark):
    """The join of rows and keys is split by adaptive execution where one digest holds a third of the rows."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    docs = make_docs(spark, ["one hot text"] * 4000 + [f"text {i}" for i in range(4000)]).repartition(8)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        members = C.DigestIndex(spark).insert(docs).members()
        assert members.where("group_size = 4000").count() == 4000
        rows = members.select("rid", "kept")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(unhex(if(id = 0, 'FF2041', 'FF41')) AS string) AS text FROM range(2)")
    got = sorted((r.doc_id, r.keep_id, r.group_size) for r in C.duplicate_groups(docs).collect())
    assert got == [(0, 0, 2), (1, 0, 2)] and C.drop_duplicates(docs).count() == 1


def test_filter_overflow_and_deletion():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    shard = C.Shard(buckets=2)
    for i, d in enumerate(digests):
        shard.insert([d, 1, 5, i, i])
        if i % 3 == 0:
            shard.insert([d, 2, 6, i + 1, i])
    assert shard.filter.buckets >= 1024
    assert all(d in shard.filter and shard._find(d) is not None for d in digests)
    assert shard._find(digests[0])[1:4] == [3, 6, 1]
    again = C.CuckooFilter(shard.filter.buckets, shard.filter.packed())
    assert all(d in again for d in digests)
    for d in digests[::2]:
        shard.delete(d)
    assert all(shard._find(d) is None for d in digests[::2]) and all(d in shard.filter for d in digests[1::2])
    assert sum(map(len, shard.filter.table)) == len(digests[1::2])
