"""Small frames and plain-Python versions that the operator tests compare with."""
from __future__ import annotations

import random
import re
from itertools import combinations

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, sources=None, langs=None, ids=None):
    rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng: random.Random, n: int) -> str:
    """Sentences over a small vocabulary with function words."""
    stems = ["river", "stone", "lamp", "garden", "window", "market", "silver", "morning", "letter", "bridge", "harbour", "winter"]
    out = []
    for k in range(n):
        word = rng.choice(["the", "of", "and", "to", "in", *stems, *(s + rng.choice("abcdefgh") + str(rng.randrange(50)) for s in stems)])
        out.append(word + ("." if k % 11 == 10 else ""))
    return " ".join(out)


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    w = WORDS.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def components(texts: dict[int, str | None], width: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def near_copies(rng: random.Random, groups: int, copies: int, length: int, changes: int) -> list[str]:
    """Groups of texts that differ from their first one in some words."""
    out = []
    for _ in range(groups):
        base = prose(rng, length).split()
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randrange(changes + 1) if c else 0):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return out
