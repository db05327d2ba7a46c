import random
import re

import numpy as np
import pytest

from tipscope.llm import url_filter as U

RULES = U.HOST_RULES


def fits(host, path, rule):
    _, h, p = rule
    return (host == h or host.endswith("." + h)) and path.startswith(p)


def judged(url):
    host, path = U.split_url(url)
    found = [r for r in RULES if fits(host, path, r)]
    if found:
        best = max(found, key=lambda r: (len(r[1] + r[2]), r[0] == "block"))
        return host, path, best[1] + best[2], best[0]
    hit = any(re.fullmatch(re.escape(g).replace(r"\*", "(?s:.*)").replace(r"\?", "(?s:.)"), host + path) for g in U.BLOCKED_GLOBS)
    return host, path, None, "block" if hit or not host else "allow"


def cases():
    rng = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "badexample.org", "com", "x.com", "EXAMPLE.Org", "host.net:80", "user@x.com", "",
             "evil.net", "spam-farm.net", "münchen.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/fr/a", "/de/", "/x/.example.org/es/", "/login?x", "/a.exe", "/casino/b", "/CASINO"]
    out = [None, "", "no scheme", "://", "http://", "ftp://org/", "http://a/b://example.org/es/", "http://x.com" + "/y" * 40_000]
    out += [f"http{rng.choice(['', 's'])}://{h}{p}{rng.choice(['', '?q=1', '#f', '?a#b/../'])}" for h in hosts for p in paths]
    return out + out[:20]


def test_against_plain_rules(spark):
    urls = cases()
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    rows = {r.page_id: r for r in U.judge_urls(pages).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        assert tuple(rows[i])[1:5] == judged(url), url


def test_machine_against_regular_expressions():
    rng = random.Random(4)
    globs = ["".join(rng.choice("ab*?/.") for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    strings = ["".join(rng.choice("ab/.") for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    got = np.concatenate(list(U.ShiftAnd([U.glob_pattern(g) for g in globs]).match([b"." + s.encode() for s in strings])))
    for j, g in enumerate(globs):
        want = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in g))
        assert [bool(want.fullmatch(s)) for s in strings] == got[:, j].tolist(), g


def test_empty_and_null(spark):
    pages = spark.createDataFrame([(None, None)], "page_id long, url string")
    assert [tuple(r) for r in U.judge_urls(pages).collect()] == [(None, "", "", None, "block", None)]
    assert U.judge_urls(pages.limit(0)).count() == 0
    assert U.allowed_pages(pages).count() == 0


def test_many_rules_keep_the_memory_bound():
    """100,000 rules: the tables are of a known size, and urls are judged a few at a time."""
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    machine = U.ShiftAnd([U.host_pattern(f"host{i:06d}.example.net", f"/p{i % 7}/") for i in range(100_000)])
    urls = [f".www.host{i * 9999:06d}.example.net/p{i * 9999 % 7}/x" for i in range(11)] + [".host000001.example.net/p2/"]
    found = [np.flatnonzero(row).tolist() for fits in machine.match([u.encode() for u in urls]) for row in fits]
    assert found == [[i * 9999] if i * 9999 < 100_000 else [] for i in range(11)] + [[]]
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) < 1_500_000  # KB


def test_rules_from_a_table(spark):
    rules = spark.createDataFrame([("block", "Bad.ORG", "/x"), ("block", "Bad.ORG", "/x"), ("allow", "good.net", None), ("?", "a", "/"), ("block", None, "/")],
                                  "verdict string, host string, path string")
    assert U.host_rules_of(rules) == [("allow", "good.net", "/"), ("block", "bad.org", "/x")]
    with pytest.raises(ValueError):
        U.host_rules_of(rules, most=1)
    pages = spark.createDataFrame([(1, "http://a.bad.org/xy"), (2, "http://bad.org/y"), (3, "http://good.net/login")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, U.host_rules_of(rules)).collect()}
    assert got == {1: ("bad.org/x", "block"), 2: (None, "allow"), 3: ("good.net/", "allow")}
    assert {r.verdict for r in U.judge_urls(pages, [], []).collect()} == {"allow"}
