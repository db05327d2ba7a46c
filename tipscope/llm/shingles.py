"""Word shingles of whole texts as sorted 64-bit hashes, computed with numpy.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` after A-Z are
lower-cased (bytes of other letters are left alone, so the rule equals the
character rule on UTF-8).  A text with fewer words than the shingle width has
one shingle, its whole word sequence; a text without words has none.
Hashes are position-independent polynomials over the bytes, finished by a
64-bit mixer; 2**-64 is the chance that two given different shingles collide.
"""
from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_SEGMENT = 1 << 20  # bytes hashed at once; bounds the work arrays, not the text

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mixer (a bijection on 64-bit integers)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes the words of byte strings; keeps the power tables of one segment."""

    def __init__(self) -> None:
        self._up, self._down = _powers(1 << 16, _MULTIPLIER), _powers(1 << 16, _INVERSE)

    def spans(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of lower-cased bytes."""
        b = np.frombuffer(raw, dtype=np.uint8)
        n = len(b)
        if n + 1 > len(self._up):
            self._up, self._down = _powers(2 * n, _MULTIPLIER), _powers(2 * n, _INVERSE)
        word = ~_SPACE[b]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=total[1:])
        return start, mix((total[end] - total[start]) * self._down[start])

    def __call__(self, text: str | None) -> np.ndarray:
        """One hash per word, in order; no words for None."""
        raw = lowered(text)
        parts, at = [np.empty(0, np.uint64)], 0
        while at < len(raw):  # cut at white space, so no word is split
            cut = min(len(raw), at + _SEGMENT)
            while cut < len(raw) and not _SPACE[raw[cut]]:
                cut += 1
            parts.append(self.spans(raw[at:cut])[1])
            at = cut
        return np.concatenate(parts)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _shingles(words: np.ndarray, span: int) -> np.ndarray:
    n = len(words) - span + 1
    h = np.full(n, span, dtype=np.uint64)
    for k in range(span):
        h = mix(h * np.uint64(_MULTIPLIER) + words[k:n + k])
    return h


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a word-hash sequence."""
    return _distinct(_shingles(words, min(width, len(words)))) if len(words) else words


def shingle_sets(texts: list[str | None], width: int, hasher: WordHasher) -> list[np.ndarray]:
    """``shingle_set`` of every text; short texts are hashed many at a time."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        raw = b"\n".join(b for _, b in held)
        begin = np.cumsum([0] + [len(b) + 1 for _, b in held])
        start, words = hasher.spans(raw)
        first = np.searchsorted(start, begin)
        rows = _shingles(words, width) if len(words) >= width else words
        for j, (i, _) in enumerate(held):
            a, b = first[j], first[j + 1]
            out[i] = _distinct(rows[a:b - width + 1]) if b - a >= width else shingle_set(words[a:b], width)
        held.clear()

    for i, text in enumerate(texts):
        raw = lowered(text)
        if len(raw) > _SEGMENT // 2:
            out[i] = shingle_set(hasher(text), width)
            continue
        held.append((i, raw))
        size += len(raw) + 1
        if size >= _SEGMENT // 2:
            flush()
            size = 0
    if held:
        flush()
    return out
