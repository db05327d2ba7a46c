"""Language identification with string kernels.

The kernel of two texts counts the hashed character n-grams of one to four
letters that both hold (presence, all lengths blended), divided by the root of
the product of their numbers.  A Nyström map over landmark texts turns it into
short vectors, on which one ridge regression per language separates that
language from the rest.  Kernel, map and regressions are linear in the presence
bits, so they fold into one weight per bit and language, and scoring sums the
weights of a text's bits.

Presence says nothing once nearly every n-gram occurs, so a text longer than
``STRETCH`` is scored by equal stretches, all of them, and its values are their
mean by length: however long, and whatever data it holds, no bits fill up.

Training takes a bounded sample: at most ``SAMPLE`` rows over all languages,
evenly by language, those of smallest hash of id and text, and of a longer text
one stretch by the same hash.  Of more than ``SAMPLE / LEAST`` (150) languages
those with most rows are learned and the others never predicted.  Only presence
bits (32 KB a row) reach the driver; every text of the table is scored whole, a
block of stretches in one matrix product.  A worker holds 1 MB of weights a
language.

Edge cases: a NULL text or one without a letter is ``und`` with score 0; rows
with a NULL language, or with a NULL id, teach nothing; rows alike in id and
text teach once, and those of one id with other texts each; without any teaching
row every text is ``und``; with one language every text with letters is that
language; repeated rows are scored one by one; extra columns are not read.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.shingles import mix

ORDERS = (1, 2, 3, 4)
BITS = 18  # presence bits: 2 ** BITS
STRETCH = 1 << 15  # letters and blanks scored together; fills at most half of the bits
SAMPLE, LEAST = 1200, 8
LANDMARKS = 192
RIDGE = 1e-2
UNKNOWN = "und"
SCORED = 32  # presence rows scored by one matrix product
_BLOCK = 1 << 10  # bytes of packed presence rows per matrix product
_SEGMENT = 1 << 18  # characters hashed at once; bounds the work arrays, not the text


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


class Presence:
    """Marks the hashed n-grams of whole texts."""

    def __init__(self) -> None:
        self.letter = _letters()

    def codes(self, text: str) -> np.ndarray:
        """Lower-case letters as code points; runs of anything else between them are one blank."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        low = c < 1 << 16
        keep = np.where(low, self.letter[np.where(low, c, 0)], False)
        if not low.all():
            keep[~low] = [chr(x).isalpha() for x in c[~low]]
        c = np.where(keep, c, 32)
        c = c[np.concatenate(([True], keep[1:] | keep[:-1]))] if len(c) else c
        if len(c) and c[-1] == 32:
            c = c[:-1]
        return (c[1:] if len(c) and c[0] == 32 else c).astype(np.uint64)

    def _mark(self, c: np.ndarray) -> np.ndarray:
        """Presence of the n-grams of code points."""
        seen = np.zeros(1 << BITS, dtype=bool)
        for at in range(0, len(c), _SEGMENT):
            part = c[at:at + _SEGMENT + max(ORDERS) - 1]
            gram = np.zeros(len(part), np.uint64)
            for order in range(1, max(ORDERS) + 1):
                n = len(part) - order + 1
                if n <= 0:
                    break
                gram = (gram[:n] << np.uint64(16)) ^ (part[order - 1:order - 1 + n] * np.uint64(0x9E3779B1))
                if order in ORDERS:
                    seen[mix(gram + np.uint64(order)) >> np.uint64(64 - BITS)] = True
        return seen

    def _framed(self, text: str | None) -> np.ndarray:
        """Code points between two blanks; nothing if the text has no letter."""
        c = self.codes(text or "")
        return np.concatenate(([32], c, [32])).astype(np.uint64) if len(c) else c

    def row(self, text: str | None) -> np.ndarray | None:
        """Presence of every n-gram; None if the text has no letter."""
        c = self._framed(text)
        return self._mark(c) if len(c) else None

    def cuts(self, text: str | None) -> list[tuple[int, np.ndarray]]:
        """Equal stretches that make up a text: length, and code points with those that its last n-grams reach."""
        c = self._framed(text)
        n = -(-len(c) // STRETCH)
        ends = [k * len(c) // n for k in range(n + 1)] if n else []
        return [(end - begin, c[begin:end + max(ORDERS) - 1]) for begin, end in zip(ends, ends[1:])]

    def stretches(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """Length and presence of each stretch of a text; none if it has no letter."""
        return ((n, self._mark(c)) for n, c in self.cuts(text))

    def teaching(self, text: str | None, key: int) -> np.ndarray | None:
        """Packed presence of the stretch of a text that a hash picks; None if it has no letter."""
        cuts = self.cuts(text)
        return np.packbits(self._mark(cuts[key % len(cuts)][1])) if cuts else None


def _blocks(rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The bits of packed rows as numbers, some columns at a time."""
    for at in range(0, rows.shape[1], _BLOCK):
        yield slice(8 * at, 8 * (at + _BLOCK)), np.unpackbits(rows[:, at:at + _BLOCK], axis=1).astype(np.float32)


class KernelRidge:
    """Nyström map and one-versus-rest ridge regressions over packed presence rows."""

    def __init__(self, rows: np.ndarray, languages: list[str]) -> None:
        self.languages = sorted(set(languages))
        by_language = [[i for i, x in enumerate(languages) if x == name] for name in self.languages]
        share = max(1, LANDMARKS // len(self.languages))
        chosen = [i for own in by_language for i in own[:share]]
        both, size = np.zeros((len(rows), len(chosen))), np.zeros(len(rows))
        for _, block in _blocks(rows):
            size += block.sum(axis=1)
            used = block[chosen].any(axis=0)
            both += block[:, used] @ block[np.ix_(chosen, used)].T
        root = np.sqrt(np.maximum(size, 1))
        kernel = both / root[:, None] / root[chosen]
        values, vectors = np.linalg.eigh(kernel[chosen])
        good = values > 1e-6 * values.max()
        mapped = kernel @ (vectors[:, good] / np.sqrt(values[good]))
        target = np.where(np.array(languages)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        weight = np.array([1.0 / languages.count(x) for x in languages])  # languages count alike
        weight *= len(languages) / weight.sum() / 1.0
        mean, centre = weight @ mapped / weight.sum(), weight @ target / weight.sum()
        z, y = (mapped - mean) * np.sqrt(weight)[:, None], (target - centre) * np.sqrt(weight)[:, None]
        beta = np.linalg.solve(z.T @ z + RIDGE * len(languages) * np.eye(z.shape[1]), z.T @ y)
        coefficients = (vectors[:, good] / np.sqrt(values[good])) @ beta / root[chosen][:, None]
        self.intercept = centre - mean @ beta
        self.weights = np.empty((8 * rows.shape[1], len(self.languages)), np.float32)
        for at, block in _blocks(rows[chosen]):
            self.weights[at] = block.T @ coefficients

    def values(self, rows: np.ndarray) -> np.ndarray:
        """Value of each language for each presence row of a block: one matrix product
        over the bits that the block holds."""
        used = np.flatnonzero(rows.any(axis=0))
        block = rows[:, used].astype(np.float32)
        size = np.maximum(block.sum(axis=1, dtype=float), 1.0)
        return (block @ self.weights[used]).astype(float) / np.sqrt(size)[:, None] + self.intercept

    def predict_all(self, texts: Iterable[Iterable[tuple[int, np.ndarray]]]) -> list[tuple[str, float]]:
        """For each text (its stretches: length and presence) the best language and its
        share of a softmax over all; a text without stretches is unknown."""
        totals: list[np.ndarray] = []
        lengths: list[int] = []
        held: list[tuple[int, int, np.ndarray]] = []

        def flush() -> None:
            if held:
                for (text, n, _), value in zip(held, self.values(np.stack([h[2] for h in held]))):
                    totals[text] += n * value
                held.clear()

        for stretches in texts:
            totals.append(np.zeros(len(self.languages)))
            lengths.append(0)
            for n, seen in stretches:
                lengths[-1] += n
                held.append((len(totals) - 1, n, seen))
                if len(held) == SCORED:
                    flush()
        flush()
        out = []
        for total, length in zip(totals, lengths):
            value = total / max(length, 1)
            odds = np.exp(4.0 * (value - value.max()))
            best = int(value.argmax())
            out.append((self.languages[best], float(odds[best] / odds.sum())) if length else (UNKNOWN, 0.0))
        return out

    def predict(self, stretches: Iterable[tuple[int, np.ndarray]]) -> tuple[str, float]:
        """:meth:`predict_all` of one text."""
        return self.predict_all([stretches])[0]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function: packed presence bits of teaching texts that have letters."""
    presence = Presence()
    for batch in batches:
        rows = [(lang, key, presence.teaching(text, key)) for lang, key, text in zip(*(batch[c].to_pylist() for c in ("lang", "key", "text")))]
        rows = [(lang, key, seen.tobytes()) for lang, key, seen in rows if seen is not None]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.binary()))],
                                         ["lang", "key", "bits"])


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def _taught(rows: DataFrame, each: int) -> list[tuple[str, int, bytes]]:
    """Language, key and presence bits of the rows of smallest key, ``each`` of a language, equal rows once."""
    order = Window.partitionBy("lang").orderBy("key")
    once = rows.groupBy("lang", "key").agg(F.min("text").alias("text"))
    chosen = once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("lang", "key", "text")
    return sorted((r["lang"], r["key"], bytes(r["bits"])) for r in chosen.mapInArrow(_marks, "lang string, key long, bits binary").collect())


def train(docs: DataFrame, sample: int = SAMPLE) -> KernelRidge | None:
    """Learn from the texts and non-NULL languages of the rows outside the held-out fold."""
    able = docs.select(F.col("doc_id"), F.col("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & (_fold(F.col("doc_id")) != 2))
    able = able.withColumn("key", F.xxhash64("doc_id", "text"))
    sizes = able.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).cache()
    languages = sizes.count()
    if not languages:
        sizes.unpersist()
        return None
    most = max(sample, SAMPLE) // LEAST
    if languages > most:  # the languages with most rows; the bounds hold for any number of labels
        every, sizes = sizes, sizes.orderBy(F.desc("n"), "lang").limit(most).cache()
        languages = sizes.count()
        every.unpersist()
    each = max(LEAST, sample // languages)
    # first a share of each language by its hash, four times what is wanted, then the exact number
    share = F.least(F.lit(1.0), F.lit(4.0 * each) / F.col("n"))
    some = able.join(sizes, "lang").where((F.pmod("key", F.lit(1 << 30)) / F.lit(float(1 << 30))) <= share)
    marked = _taught(some, each)
    got = Counter(m[0] for m in marked)
    short = [r["lang"] for r in sizes.where(F.col("n") > 4 * each).collect() if got[r["lang"]] < LEAST]
    if short:  # too few rows below the share: the smallest hashes of all rows
        marked = sorted([m for m in marked if m[0] not in short] + _taught(able.where(F.col("lang").isin(short)), each))
    sizes.unpersist()
    if not marked:
        return None
    rows = np.frombuffer(b"".join(m[2] for m in marked), np.uint8).reshape(len(marked), -1)
    return KernelRidge(rows, [m[0] for m in marked])


def _classify(model: KernelRidge | None):
    """Map function: language and score of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = model.predict_all(map(presence.stretches, texts)) if model is not None else [(UNKNOWN, 0.0)] * len(texts)
            said, score = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(said, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: KernelRidge | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(_fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_classify(model), "doc_id long, held_out boolean, lang_pred string, score double")


def language_of(docs: DataFrame) -> DataFrame:
    """Train on the table's own labelled rows, then score every row."""
    return identify(docs, train(docs))
