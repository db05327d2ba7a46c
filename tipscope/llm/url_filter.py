"""URL rules judged by a bit-parallel wildcard automaton.

All rules are packed side by side into one multiword Shift-And machine: a rule
of m symbols owns m + 1 state bits, a ``*`` is a self-loop on the state before
the next symbol.  One step per byte moves every rule of every url of a batch:
``D = (D << 1) & B[byte] | D & L[byte]``, with B the bits that byte enters and
L the bits that loop on it.  The work is the sum of url lengths times words of
state, whatever the number of rules that match.

Edge cases: a NULL url, or one without ``://``, has an empty host and path, no
rule and is blocked; an empty host is blocked too (such a row names no page).
Host rules without a path never fit a url without a path.  Of two fitting rules
of equal length the blocking one wins.  Repeated rows are judged one by one and
extra columns are never read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Verdict, host and path prefix of the contract's rules (fixed values).
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Globs over ``host/path`` for urls that no host rule fits: these are blocked.
BLOCKED_GLOBS = ("*spam*", "*cheap-pills*", "*casino*/*", "*/login*", "*.exe", "*.zip")

#: Bytes of a work array of the machine; more rules mean fewer urls at a time.
STATE_BYTES = 32 << 20
#: Rules that a task may hold: tables of about 0.4 GB.
MOST_RULES = 200_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_NOT_SLASH, _ANY = "not-slash", "any"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


@dataclass(frozen=True)
class Pattern:
    """Symbols to match in order (None is any byte), and before which of them,
    or at the end, a loop over a byte class may run."""

    symbols: tuple[int | None, ...]
    loops: dict[int, str]


def host_pattern(host: str, path: str) -> Pattern:
    """Fits ``.host/path...`` for the host and its subdomains."""
    symbols = tuple(f".{host}{path}".encode())
    return Pattern(symbols, {0: _NOT_SLASH, len(symbols): _ANY})


def glob_pattern(glob: str) -> Pattern:
    """``*`` any bytes, ``?`` one byte, over the url ``host/path``."""
    symbols: list[int | None] = [ord(".")]
    loops = {}
    for b in glob.encode():
        if b == ord("*"):
            loops[len(symbols)] = _ANY
        else:
            symbols.append(None if b == ord("?") else b)
    return Pattern(tuple(symbols), loops)


class ShiftAnd:
    """The packed machine of many patterns; ``match`` runs it over many strings."""

    def __init__(self, patterns: Sequence[Pattern]) -> None:
        sizes = np.array([len(p.symbols) + 1 for p in patterns], np.int64)
        begins = np.cumsum(sizes) - sizes
        self.words = max(1, -(-int(sizes.sum()) // 64))
        self.enter = np.zeros((256, self.words), dtype=np.uint64)
        self.loop = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self._set(self.start, begins)
        self.final = begins + sizes - 1
        symbols = np.fromiter((-1 if x is None else x for p in patterns for x in p.symbols), np.int64)
        places = np.repeat(begins + 1, sizes - 1) + np.arange(len(symbols)) - np.repeat(np.cumsum(sizes - 1) - (sizes - 1), sizes - 1)
        given = symbols >= 0
        np.bitwise_or.at(self.enter, (symbols[given], places[given] >> 6), self._bits(places[given]))
        anything = np.zeros(self.words, dtype=np.uint64)
        self._set(anything, places[~given])
        self.enter |= anything
        loops = {kind: np.zeros(self.words, dtype=np.uint64) for kind in (_ANY, _NOT_SLASH)}
        for kind, bits in loops.items():
            self._set(bits, np.fromiter((at + k for at, p in zip(begins.tolist(), patterns) for k, x in p.loops.items() if x == kind), np.int64))
            self.loop |= bits
        self.loop[ord("/")] &= ~loops[_NOT_SLASH] | loops[_ANY]

    @staticmethod
    def _bits(places: np.ndarray) -> np.ndarray:
        return np.uint64(1) << (places & 63).astype(np.uint64)

    def _set(self, row: np.ndarray, places: np.ndarray) -> None:
        np.bitwise_or.at(row, places >> 6, self._bits(places))

    def match(self, strings: Sequence[bytes]) -> Iterator[np.ndarray]:
        """Boolean matrices, string i fits pattern j, of so many strings at a time
        that the work arrays keep their bound, whatever the number of patterns."""
        some = max(1, min(STATE_BYTES // (8 * self.words), STATE_BYTES // (8 * max(1, len(self.final)))))
        for at in range(0, len(strings), some):
            yield self._match(strings[at:at + some])

    def _match(self, strings: Sequence[bytes]) -> np.ndarray:
        n = len(strings)
        length = np.fromiter(map(len, strings), np.int64, n)
        order = np.argsort(-length, kind="stable")  # the strings still running are a prefix
        buf = np.frombuffer(b"".join(strings), dtype=np.uint8)
        begin = (np.cumsum(length) - length)[order]
        running = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")
        state = np.tile(self.start, (n, 1))
        for t, live in enumerate(running):
            d = state[:live]
            byte = buf[begin[:live] + t]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.enter[byte] | d & self.loop[byte]
        fits = np.empty((n, len(self.final)), dtype=bool)
        fits[order] = state[:, self.final >> 6] & self._bits(self.final) != 0
        return fits


_SCHEMA = "page_id long, host string, path string, rule string, verdict string, glob string"


def judge_urls(pages: DataFrame, host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
               blocked_globs: Sequence[str] = BLOCKED_GLOBS) -> DataFrame:
    """One row per page: host, path, the longest fitting host rule, the glob
    that decided where no rule fits, and the verdict.  Narrow: no shuffle."""
    # later rules overwrite earlier ones: longest last, blocking last among equals
    ranked = sorted(host_rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1]))
    globs = list(blocked_globs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ShiftAnd([host_pattern(h, p) for _, h, p in ranked] + [glob_pattern(g) for g in globs])
        names, said = [None, *(h + p for _, h, p in ranked)], [None, *(v for v, _, _ in ranked)]
        for batch in batches:
            parts = [split_url(u) for u in batch["url"].to_pylist()]
            rule, verdict, glob = [], [], []
            for fits in machine.match([f".{h}{p}".encode("utf-8", "surrogatepass") for h, p in parts]):
                by_rule, by_glob = fits[:, :len(ranked)], fits[:, len(ranked):]
                # the last fitting rule (0: none), the first fitting glob (-1: none)
                last = np.where(by_rule.any(axis=1), len(ranked) - by_rule[:, ::-1].argmax(axis=1), 0) if ranked else np.zeros(len(fits), int)
                first = np.where(by_glob.any(axis=1), by_glob.argmax(axis=1), -1) if globs else np.full(len(fits), -1)
                for (host, _), r, g in zip(parts[len(rule):], last.tolist(), first.tolist()):
                    rule.append(names[r])
                    glob.append(globs[g] if g >= 0 and not r else None)
                    verdict.append(said[r] if r else "block" if g >= 0 or not host else "allow")
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"].cast(pa.int64()), pa.array([h for h, _ in parts], pa.string()),
                 pa.array([p for _, p in parts], pa.string()), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string()), pa.array(glob, pa.string())],
                ["page_id", "host", "path", "rule", "verdict", "glob"])

    return pages.select("page_id", "url").mapInArrow(judge, _SCHEMA)


def host_rules_of(table: DataFrame, most: int = MOST_RULES) -> list[tuple[str, str, str]]:
    """Host rules from a table (``verdict``, ``host``, ``path``), such as a published block
    list; more than ``most`` distinct rules are an error, since every task holds them all."""
    lowered = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = table.where("host IS NOT NULL AND verdict IN ('allow', 'block')").select(
        "verdict", lowered.alias("host"), F.coalesce("path", F.lit("/")).alias("path")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    return sorted((r["verdict"], r["host"], r["path"]) for r in rows)


def allowed_pages(pages: DataFrame, **options: object) -> DataFrame:
    """The judged rows that may be crawled."""
    return judge_urls(pages, **options).where("verdict = 'allow'")
