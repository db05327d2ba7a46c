import random

import numpy as np
import pytest

from llm_frames import components, make_docs, near_copies, prose, shingles
from tipscope.llm import jaccard as J
from tipscope.llm.components import connected_components
from tipscope.llm.shingles import WordHasher, shingle_set, shingle_sets
from tipscope.llm.tables import Workspace

EDGES = [None, "", " \n\t ", "one", "One", "one two", "ONE  two", "one two three", "one two three four", "one two three four",
         "É two three four", "é two three four", "a\x85b c d e f", "the same " * 400]


def compare(spark, texts, width, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           J.near_duplicate_components(make_docs(spark, texts), width, percent).collect()}
    want = components(dict(enumerate(texts)), width, percent)
    assert got == {i: (len(shingles(t, width)), want[i]) for i, t in enumerate(texts)}
    return want


@pytest.mark.parametrize("width,percent,changes", [(4, 85, 6), (5, 80, 9)])
def test_components_against_brute_force(spark, width, percent, changes):
    rng = random.Random(width)
    passage = prose(rng, 60)
    texts = EDGES + near_copies(rng, 12, 6, 120, changes) + near_copies(rng, 6, 5, 14, 2)
    texts += [passage + " " + prose(rng, 20) for _ in range(25)] + [passage] * 10 + [prose(rng, 3000)] * 2
    want = compare(spark, texts, width, percent)
    assert 10 < len(set(want.values())) < len(texts)


def test_large_group_of_near_copies(spark):
    """Many classes share most of their hashes; only some of them link."""
    rng = random.Random(8)
    compare(spark, near_copies(rng, 1, 150, 60, 5) + near_copies(rng, 1, 100, 60, 14), 4, 85)


def test_pairs_lose_no_link(spark):
    rng = random.Random(14)
    texts = EDGES + near_copies(rng, 5, 8, 200, 4)
    linked, member = (df.collect() for df in J.JaccardJoin(make_docs(spark, texts), 5, 80).pairs())
    sets = {i: shingles(t, 5) for i, t in enumerate(texts)}
    first = {}
    for i, s in sets.items():
        first.setdefault(frozenset(s) if s else i, i)
    of = {i: first[frozenset(s) if s else i] for i, s in sets.items()}
    assert {r.doc_id: r.class_id for r in member} == of
    reps = sorted(set(of.values()))
    want = {(a, b) for a in reps for b in reps if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r.id_a, r.id_b) for r in linked} == want and len(want) > 20


def test_keep_one(spark):
    rng = random.Random(2)
    base = prose(rng, 100)
    docs = spark.createDataFrame([(5, base, "a", 1), (3, base + " end", "b", 2), (9, None, "c", 3), (10, "", "d", 4), (11, "solo words here", "e", 5)],
                                 "doc_id long, text string, gone_id string, n int")
    out = J.keep_one_per_component(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 9, 10, 11]


def test_repeated_and_null_ids_and_empty(spark):
    a, b = prose(random.Random(3), 50), prose(random.Random(4), 50)
    docs = make_docs(spark, [a, a, a, b, b], ids=[4, 4, None, None, None])
    got = [(r.doc_id, r.component_id) for r in J.near_duplicate_components(docs).collect()]
    assert sorted(got, key=str) == sorted([(4, 4), (4, 4), (None, 4), (None, None), (None, None)], key=str)
    kept = [(r.doc_id, r.text) for r in J.keep_one_per_component(docs).collect()]
    assert (4, a) in kept and (None, b) in kept
    assert J.near_duplicate_components(make_docs(spark, [])).count() == 0


def test_shingle_sets_do_not_depend_on_batching():
    rng = random.Random(6)
    texts = [*EDGES, *(prose(rng, rng.randrange(0, 300)) for _ in range(100)), "tail " * 300_000]
    hasher = WordHasher()
    for text, got in zip(texts, shingle_sets(texts, 4, hasher)):
        assert np.array_equal(got, shingle_set(WordHasher()(text), 4))
        assert len(got) == len(shingles(text, 4)) if text is None or len(text) < 10 ** 5 else len(got) == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in connected_components(df, Workspace(spark, "t"), "t").collect()}
    assert got == {x: find(x) for x in parent if any(x in link and link[0] != link[1] for link in links)}
