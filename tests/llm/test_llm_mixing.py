import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from llm_frames import make_docs, prose, words
from tipscope.llm import mixing as M


def number(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:M._HASH_DIGITS], 16)


def identity(doc_id, text):
    return hashlib.md5(f"{'null' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()


def expected(rows, budget=None, limit=M.MAX_REPETITION, seed=42):
    """(doc index, pass) pairs of the mix, in plain Python."""
    tokens = [len(words(t)) for _, t, _ in rows]
    by = defaultdict(list)
    for i, (_, _, s) in enumerate(rows):
        by[s].append(i)
    total = {s: sum(tokens[i] for i in own) for s, own in by.items()}
    sizes = sorted(float(t) for t in total.values() if t)
    out = []

    def weights(x):
        p = [(s / sizes[-1]) ** x for s in sizes]
        return [v / sum(p) for v in p]

    def fine(x):
        r = [w / s for w, s in zip(weights(x), sizes)]
        return (max(r) * budget if budget else max(r) / min(r)) <= limit

    if sizes:
        low, high = 0.0, 1.0
        for _ in range(M.BISECTIONS):
            mid = (low + high) / 2
            low, high = (low, mid) if fine(mid) else (mid, high)
        x = round(0.0 if fine(0.0) else high, 9)
        norm = sum((s / sizes[-1]) ** x for s in sizes)
        cover = max(s / (s / sizes[-1]) ** x for s in sizes)
    for s, own in by.items():
        passes = 1.0
        if total[s]:
            passes = round((total[s] / sizes[-1]) ** x / norm * (budget or cover * norm) / total[s], 6)
        whole, rest = math.floor(passes), round((passes - math.floor(passes)) * total[s])
        out += [(i, e) for i in own for e in range(whole)]
        n_blocks = math.ceil(math.sqrt(len(own)))

        def place(i, e=whole, n_blocks=n_blocks, s=s):
            me = identity(rows[i][0], rows[i][1])
            block = number(f"{seed}:deal", me) % n_blocks
            return number(f"{seed}:block", str(e), s or "null", str(block)), block, number(f"{seed}:doc", str(e), me)

        spent, last = 0, None
        for i in sorted(own, key=place):
            if rest and (spent < rest or place(i) == last):
                out.append((i, whole))
                last = place(i)
            spent += tokens[i]
    return Counter(out)


def frame(seed=1, n=300):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(0, 60)), rng.choice(["big"] * 8 + ["mid"] * 3 + ["small", None])) for i in range(n)]
    return rows + [(900, None, "empty"), (901, " ", "empty"), (902, "", "big"), (None, "a b c", "mid"), (5, rows[5][1], rows[5][2])]


@pytest.mark.parametrize("budget", [None, 4000.0, 30000.0])
def test_stream_against_plain_python(spark, budget):
    rows = frame()
    docs = make_docs(spark, [t for _, t, _ in rows], sources=[s for *_, s in rows], ids=[i for i, *_ in rows])
    want = Counter()
    for (i, e), n in expected(rows, budget, limit=3.0).items():
        want[rows[i][0], rows[i][2], len(words(rows[i][1])), e] += n
    mix = M.Mix(docs, budget=budget, max_repetition=3.0)
    assert Counter((r.doc_id, r.source, r.n_tokens, r.epoch) for r in mix.stream().collect()) == want
    got = Counter((r.doc_id, r.source) for r in mix.mixed().collect())
    assert got == Counter({k: sum(n for (d, s, *_), n in want.items() if (d, s) == k) for k in {(d, s) for d, s, *_ in want}})


def test_limits_and_entropy(spark):
    rows = frame(2, 600)
    docs = make_docs(spark, [t for _, t, _ in rows], sources=[s for *_, s in rows], ids=[i for i, *_ in rows])
    plan = {r.source: r for r in M.Mix(docs, max_repetition=2.5).plan.collect()}
    passes = [r.passes for r in plan.values() if r.tokens]
    assert max(passes) == pytest.approx(2.5, abs=1e-3) and min(passes) == 1.0
    assert sum(r.weight for r in plan.values()) == pytest.approx(1)
    assert plan["empty"].weight == 0 and plan["empty"].passes == 1
    plan = M.Mix(docs, budget=10000, max_repetition=None, entropy=0.95).plan.where("tokens > 0").collect()
    assert -sum(r.weight * math.log(r.weight) for r in plan) == pytest.approx(0.95 * math.log(len(plan)), abs=1e-4)
    with pytest.raises(ValueError):
        M.Mix(docs, max_repetition=None)


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x"), (2, "c", "t", "y")], "doc_id long, text string, source string, epochs string")
    out = M.Mix(docs).mixed()
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} >= {(1, "a b", "s", "x"), (2, "c", "t", "y")}
    empty = make_docs(spark, [])
    assert M.Mix(empty).stream().count() == 0 and M.Mix(empty).mixed().count() == 0
    only = make_docs(spark, [None, "", " "], sources=["a", None, "a"])
    assert M.Mix(only).mixed().count() == 3


def test_token_column_is_the_measure(spark):
    rows = [(i, "日本語の文章です", "ja", 50) for i in range(8)] + [(100 + i, "a b c d e", "en", 5) for i in range(8)] + [(200, "x", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    plan = {r.source: r for r in M.Mix(docs, budget=1000.0, max_repetition=100.0, tokens="n").plan.collect()}
    assert (plan["ja"].tokens, plan["en"].tokens) == (400, 40)
    assert {r.source: r.tokens for r in M.Mix(docs).plan.collect()} == {"ja": 8, "en": 41}
    mix = M.Mix(docs, max_repetition=2.0, tokens="n")
    assert {r.n_tokens for r in mix.stream().collect()} == {50, 5, 0} and mix.mixed().columns == docs.columns


@pytest.mark.parametrize("kind", ["repetition", "budget", "entropy"])
def test_a_million_sources(spark, kind):
    """The exponent comes from sums, whatever the number of sources."""
    n = 1_000_000 if kind == "repetition" else 200_000
    sources = spark.range(n).selectExpr("id AS source", "1 + id % 1000 AS tokens")
    total = sum(1 + i % 1000 for i in range(n))
    budget, limit, entropy = {"repetition": (None, 1.5, None), "budget": (float(total), 3.0, None), "entropy": (None, None, 0.99)}[kind]
    x = M.solve_exponent(sources, budget, limit, entropy)
    sizes = [float(1 + i) for i in range(1000)]
    powers = [(s / 1000.0) ** x for s in sizes]
    norm = sum(powers) * (n // 1000)
    if kind == "repetition":
        assert 1000.0 ** (1 - x) == pytest.approx(1.5, abs=1e-6)
    elif kind == "budget":
        assert max(p / norm / s for p, s in zip(powers, sizes)) * budget == pytest.approx(3.0, abs=1e-5)
    else:
        held = -sum(p / norm * math.log(p / norm) for p in powers) * (n // 1000) / math.log(n)
        assert held == pytest.approx(0.99, abs=1e-6)
