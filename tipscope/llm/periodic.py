"""Periodic runs in word sequences by a dictionary of basic factors.

A run is a longest stretch of words with smallest period q, of at least
``max(least, 3 q)`` words.  For every power of two the dictionary names the
stretches (factors) of that many words, a name being the hash of the names of
its halves.  Successive occurrences of a name that are at most twice the length
apart propose their distance as a period; neighbouring positions with one
distance are one arithmetic progression and one proposal.  Proposals are
extended to both sides by comparing words, proposals inside a stretch already
extended are left out, and stretches with a smaller period are discarded.

Every run is found: take the factor length l with q <= l < 2 q (or FIRST, if q
is smaller).  At the run's start a factor of that length occurs again q words
later, inside the run, and nowhere between, as a smaller distance would be a
smaller period of the run.  So no length below FIRST is asked for occurrences.
A position whose factor does not occur twice in its text cannot start a longer
factor that does; it leaves, and few positions reach the long lengths.

Texts are handled many at a time; names hold the text's number, so no factor
occurs in two texts.  Words are compared by 64-bit hashes.

Edge cases: NULL, empty and word-less texts have no words and no runs; a NULL
id leaves its words as they are; repeated rows are rows of their own; extra
columns are not read; text that is not valid UTF-8 is read as bytes.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipscope.llm.shingles import WordHasher, mix

#: The shortest run, and the shortest factors whose occurrences are looked up:
#: a run of 24 words has every period up to 8 at factors of 8 words.
LEAST, FIRST = 24, 8
#: Bytes of text handled at once; a longer text is handled alone.
GROUP_BYTES = 1 << 20
#: Words joined at once for the digest of a collapsed text.
JOINED = 1 << 16

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(raw: bytes, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word."""
    parts, at = [], 0
    while at < len(raw):  # cut at white space, so no word is split
        cut = min(len(raw), at + GROUP_BYTES)
        while cut < len(raw) and not _SPACE[raw[cut]]:
            cut += 1
        start, hashes = hasher.spans(raw[at:cut])
        word = ~_SPACE[np.frombuffer(raw, np.uint8, cut - at, at)]
        parts.append((start + at, np.flatnonzero(word & ~np.append(word[1:], False)) + 1 + at, hashes))
        at = cut
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a text that is made periodic from some word on, else None."""
    if doc_id is None or n == 0 or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def _proposals(position: np.ndarray, name: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each progression of successive occurrences, and the
    positions whose name occurs more than once."""
    order = np.argsort(name, kind="stable")  # positions stay in order within a name
    same = name[order[1:]] == name[order[:-1]]
    again = np.zeros(len(name), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    here, there = position[order[:-1][same]], position[order[1:][same]]
    near = there - here <= 2 * length
    here, gap = here[near], (there - here)[near]
    by = np.argsort(here)
    here, gap = here[by], gap[by]
    begins = np.ones(len(here), bool)
    begins[1:] = (here[1:] != here[:-1] + 1) | (gap[1:] != gap[:-1])
    return np.stack([here[begins], gap[begins]], axis=1), again


def _equal_until(x: np.ndarray, at: int, gap: int, step: int) -> int:
    """The first position from ``at`` on in the direction of ``step`` whose word
    differs from the one ``gap`` later (or has none)."""
    size = 16
    while 0 <= at and at + gap < len(x):
        if step > 0:
            end = min(at + size, len(x) - gap)
            differ = np.flatnonzero(x[at:end] != x[at + gap:end + gap])
            if len(differ):
                return at + int(differ[0])
            at = end
        else:
            begin = max(at - size + 1, 0)
            differ = np.flatnonzero(x[begin:at + 1] != x[begin + gap:at + 1 + gap])
            if len(differ):
                return begin + int(differ[-1])
            at = begin - 1
        size = min(2 * size, 1 << 16)
    return at


def _has_smaller_period(x: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of three periods or more has a proper divisor of its
    period as a period: only divisors can be (Fine and Wilf)."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = period // prime
            if np.array_equal(x[start:start + period], x[start + part:start + part + period]):
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def runs_of(x: np.ndarray, least: int = LEAST, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word hashes.

    ``longest`` is the length of the longest text in it: no run has a period
    above a third of that, so longer factors are not needed."""
    first = min(FIRST, 1 << max(0, (least // 3).bit_length() - 1))
    longest = len(x) if longest is None else longest
    found: set[tuple[int, int, int]] = set()
    position, name, length = np.arange(len(x)), x, 1
    while len(position) and 3 * length <= 2 * longest:
        again = np.ones(len(position), bool)
        if length >= first:
            progressions, again = _proposals(position, name, length)
            done: dict[int, int] = {}  # by distance: end of the last stretch extended
            for at, gap in progressions.tolist():
                if at < done.get(gap, -1):
                    continue
                end = _equal_until(x, at, gap, 1) + gap
                done[gap] = end - gap
                if end - at < least and x[at - 1] != x[at - 1 + gap]:
                    continue
                start = _equal_until(x, at - 1, gap, -1) + 1 if at else 0
                if end - start >= max(least, 3 * gap) and not _has_smaller_period(x, start, gap):
                    found.add((start, end - start, gap))
        position, name = position[again], name[again]
        half = np.searchsorted(position, position + length)
        both = np.flatnonzero(half < len(position))
        both = both[position[half[both]] == position[both] + length]
        name = mix(name[both] * _MULTIPLIER + name[half[both]] + np.uint64(length))
        position, length = position[both], 2 * length
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed_digest(raw: bytes, start: np.ndarray, end: np.ndarray, kept: np.ndarray) -> str:
    """SHA-256 of the kept words (numbers, in order) joined by one space."""
    digest, lead = hashlib.sha256(), b""
    for at in range(0, len(kept), JOINED):
        some = kept[at:at + JOINED]
        digest.update(lead + b" ".join([raw[s:e] for s, e in zip(start[some].tolist(), end[some].tolist())]))
        lead = b" "
    return digest.hexdigest()


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Greatest length / period; ties to the smaller start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _report(doc_id: int | None, raw: bytes, runs, start, end, order) -> tuple:
    n = len(start)
    kept = np.arange(n) if order is None else order
    if runs:
        inside = np.zeros(n + 1, np.int64)
        for begin, length, period in runs:
            inside[begin + period] += 1
            inside[begin + length] -= 1
        kept = kept[np.cumsum(inside[:n]) == 0]
    if order is None and not runs and len(raw) <= GROUP_BYTES:
        collapsed = hashlib.sha256(b" ".join(raw.split())).hexdigest()  # the same words, cut in one go
    else:
        collapsed = _collapsed_digest(raw, start, end, kept)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = _strongest(runs) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), collapsed)


_OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_NAMES = [f.split()[0] for f in _OUT.split(", ")]


def _grouped(rows: list[tuple[int | None, bytes]], planted: bool, least: int, hasher: WordHasher) -> list[tuple]:
    """Reports of some texts whose words are named together."""
    held = []
    for number, (doc_id, raw) in enumerate(rows):
        start, end, hashes = word_spans(raw, hasher)
        order = planted_order(doc_id, len(start)) if planted else None
        hashes = hashes if order is None else hashes[order]
        held.append((start, end, order, mix(hashes + np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1))))
    base = np.cumsum([0] + [len(h[0]) for h in held])
    own: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    found = runs_of(np.concatenate([h[3] for h in held]), least, max(len(h[0]) for h in held))
    for start, length, period in found:
        number = int(np.searchsorted(base, start, side="right")) - 1
        own[number].append((start - int(base[number]), length, period))
    return [_report(doc_id, raw, own[i], *held[i][:3]) for i, (doc_id, raw) in enumerate(rows)]


def _reports(planted: bool, least: int):
    """Map function: a report row per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            out, held, size = [], [], 0
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                held.append((doc_id, raw or b""))
                size += len(held[-1][1])
                if size >= GROUP_BYTES:
                    out += _grouped(held, planted, least, hasher)
                    held, size = [], 0
            if held:
                out += _grouped(held, planted, least, hasher)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _NAMES)

    return run


def periodic_runs(docs: DataFrame, planted: bool = False, least: int = LEAST) -> DataFrame:
    """Runs of every text of ``docs`` (``doc_id``, ``text``): their number, the one with
    the greatest exponent, a digest of all, and a digest of the text without the
    words that repeat a run's first period.

    ``planted`` first makes every text whose id hashes to a tenth periodic from
    some word on, which gives a known share of texts with runs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_reports(planted, least), _OUT)


def runs_table(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``period``: a row per run, in word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                runs = runs_of(word_spans(raw or b"", hasher)[2], least)
                columns = [[doc_id] * len(runs), *([r[i] for r in runs] for i in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "period"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, period long")
