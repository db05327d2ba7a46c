"""Periodic runs against a plain search over every period."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_frames import make_docs, prose, words
from tipscope.llm import periodic as P
from tipscope.llm.shingles import WordHasher


def plain_runs(w, least=24):
    """Every period in turn: longest stretches of equal words that far apart, without smaller periods."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            stretch = w[i:j + q]
            if len(stretch) >= max(least, 3 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text, planted):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def hashed(w):
    return WordHasher()(" ".join(w).encode().decode())


def nested(rng, depth):
    """A sequence of few words with repeats inside repeats."""
    w = [rng.choice("ab") for _ in range(rng.randrange(1, 5))]
    for _ in range(depth):
        w = w * rng.randrange(1, 6) + [rng.choice("abc")] * rng.randrange(0, 4) + w[:rng.randrange(len(w) + 1)]
    return w


@pytest.mark.parametrize("seed", range(12))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(40):
        w = nested(rng, rng.randrange(1, 4))[:700]
        w = prose(rng, rng.randrange(20)).split() + w + prose(rng, rng.randrange(20)).split()
        for least in (24, 3, 10, 40):
            assert P.runs_of(hashed(w), least) == plain_runs(w, least), (w, least)


def test_runs_of_special_sequences():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for w in (list(fibonacci[-1]), ["a"] * 1000, ["a"] * 23, ["a"] * 24, list("ab" * 300), list("aab" * 8), list("abcdefgh" * 3),
              list("abcdefghi" * 3)[:-1], list("abcdefghijkl" * 2), [str(i % 97) for i in range(291)], [str(i % 97) for i in range(290)], []):
        assert P.runs_of(hashed(w)) == plain_runs(w), w[:40]


def test_a_long_sequence_with_a_long_period():
    w = np.array([f"w{i % 33_333}" for i in range(100_000)])
    assert P.runs_of(hashed(w)) == [(0, 100_000, 33_333)]


@pytest.mark.parametrize("planted", [True, False])
def test_reports_against_brute_force(spark, planted):
    rng = random.Random(5)
    line = "the same line of words again and again"
    texts = [None, "", " \n\t\x0b", "one", "a " * 23, "a " * 24, "A a " * 30, "É é " * 30, "x\x85y z " * 20, "tab\tand\nline  feed " * 12]
    texts += [prose(rng, rng.randrange(400)) for _ in range(60)]
    texts += [prose(rng, 40) + ("\n" + line) * rng.randrange(2, 9) + "\n" + prose(rng, 30) for _ in range(15)]
    texts += [" ".join(nested(rng, 3)[:400]) for _ in range(15)]
    texts += [prose(rng, 9000), (prose(rng, 700) + " ") * 4]
    docs = make_docs(spark, texts).selectExpr("*", "1 AS start", "'x' AS length", "2 AS period", "3 AS n_runs")
    got = {r.doc_id: tuple(r) for r in P.periodic_runs(docs, planted).collect()}
    want = {i: plain_report(i, t, planted) for i, t in enumerate(texts)}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 20


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "left right " * 20 + "end"
    docs = make_docs(spark, [text, text, text], ids=[7, 7, None])
    got = [tuple(r) for r in P.periodic_runs(docs, planted=True).collect()]
    assert sorted(got, key=str) == sorted([plain_report(i, text, True) for i in (7, 7, None)], key=str)
    assert P.periodic_runs(make_docs(spark, ["x"]).limit(0)).collect() == []


def test_very_long_texts(spark):
    """Longer than a group and than one join of kept words."""
    rng = random.Random(2)
    text = prose(rng, 120_000) + " go on" * 90_000 + " " + prose(rng, 100)
    planted = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = make_docs(spark, [text, text], ids=[planted + 1, planted])
    for r in P.periodic_runs(docs, planted=True).collect():
        w = np.array(words(text))
        order = P.planted_order(r.doc_id, len(w))
        w = w if order is None else w[order]
        runs = P.runs_of(hashed(w))
        dropped = np.zeros(len(w), bool)
        for s, length, q in runs:
            assert (w[s:s + length - q] == w[s + q:s + length]).all()
            dropped[s + q:s + length] = True
        assert (r.n_runs > 0) and r.n_runs == len(runs)
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w[~dropped].tolist()).encode()).hexdigest()
    found = P.runs_table(docs).where("period = 2 AND length >= 180000 AND start IN (119999, 120000)")
    assert found.count() == 2


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('FF41') AS string) AS text")
    assert P.periodic_runs(docs).first().collapsed_sha256 == hashlib.sha256(b"\xffA").hexdigest()
