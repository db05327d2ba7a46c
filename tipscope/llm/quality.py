"""Quality rules: a threshold table compiled into one Spark projection.

Every figure is a built-in expression over the whole text, so the operator is
one narrow stage without user functions, shuffles or collected state.

Edge cases: a NULL or white-space-only text has no words, so all its figures
are 0 and it fails the base rule; extra columns of the input are never read,
but for the filter's language label; repeated rows and repeated ids are judged
one by one.

The stop words are those of four languages.  The filter, which drops texts,
applies a rule on them only to texts in one of these (see ``in_stop_language``);
the report applies every rule to every text, as its SQL does.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipscope.llm.tables import let

# Fixed values of the contract: white space, symbols, window and base limits.
SPACE = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "as", "with", "by", "be", "are", "or", "an", "at", "this",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "des", "auf", "ein", "im", "dem", "nicht", "ist", "eine", "für", "sich",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "est", "pour", "qui", "dans", "que", "par", "sur", "avec",
    "el", "los", "y", "del", "se", "las", "una", "con", "no", "su", "para", "es", "al", "lo", "como",
)
_STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})
#: Labels of these languages, and of no language.
STOP_LANGUAGES = ("en", "de", "fr", "es", "eng", "deu", "ger", "fra", "fre", "spa")
NO_LANGUAGE = ("", "und", "unknown")
# Letters that none of their alphabets has; a text with more than so many percent is in another language.
OTHER_LETTERS = "[\\p{L}&&[^a-zA-ZªºÀÂÄÆÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜŒŸẞßàáâäæçèéêëíîïñóôöùúûüœÿÁ]]"
OTHER_PERCENT = 1
# Capital letters of Latin script that the shouting rule counts.
CAPITALS = "[A-ZÀ-ÖØ-Þ]"


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= figure / base <= high`` (open ends are None);
    a text whose base is 0 is left to the other rules."""

    name: str
    figure: str
    base: str
    low: float | None = None
    high: float | None = None
    stop_language: bool = False  # a filter applies it to texts in a language of the stop words only

    def holds(self, value: Column) -> Column:
        top, base = value[self.figure].cast("double"), value[self.base].cast("double")
        tests = [F.lit(True)]
        if self.low is not None:
            tests.append(top >= base * F.lit(self.low))
        if self.high is not None:
            tests.append(top <= base * F.lit(self.high))
        return reduce(lambda a, b: a & b, tests)


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.5),
    Rule("shouted", "n_upper", "word_chars", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, stop_language=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs at least twice, overlaps once."""
    places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def positions(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))
        twice = F.filter(ordered, lambda _, k: same(k, k - 1) | same(k, k + 1))
        return F.array_sort(F.transform(twice, lambda p: p["i"]))

    return F.aggregate(
        let(F.array_sort(places), positions),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )


def repeat_words(words: Column) -> Column:
    """Words of windows of 8 that occur twice or more in the text.

    Windows are compared by 64-bit hash; a text without equal hashes ends
    after one hash-set pass, the others sort (hash, place) pairs.
    """
    def pairs(h: Column, step: int) -> Column:
        """Hash of each element with the one ``step`` further on (NULL past the end)."""
        return F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    def windows(h: Column) -> Column:
        eight = let(let(pairs(h, 1), lambda two: pairs(two, 2)), lambda four: pairs(four, 4))
        return F.slice(eight, 1, F.size(h) - (WINDOW - 1))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0)

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) >= WINDOW, let(hashes, count)).otherwise(0)


def _count(text: Column, chars: str) -> Column:
    return F.size(F.split(text, chars)) - 1


def figures(text: Column) -> Column:
    """All figures of one text as a struct of longs."""
    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(NOT_SPACE))

        def with_words(words: Column) -> Column:
            stop = F.filter(words, lambda w: w.isin(*_STOP_FORMS))
            return let(lines, lambda ls: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                _count(t, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                repeat_words(words).cast("long").alias("n_repeat_words"),
                F.size(ls).cast("long").alias("n_lines"),
                F.size(stop).cast("long").alias("n_stop_words"),
                _count(t, CAPITALS).cast("long").alias("n_upper"),
            ))

        return let(words_of(t), with_words)

    return let(F.coalesce(text, F.lit("")), of)


def in_stop_language(text: Column, lang: Column | None = None) -> Column:
    """Whether a text is in a language of the stop words: by its label, or by its
    letters where it has none."""
    text = F.coalesce(text, F.lit(""))
    by_letters = _count(text, OTHER_LETTERS) * 100 <= F.length(F.regexp_replace(text, SPACE, "")) * OTHER_PERCENT
    if lang is None:
        return by_letters
    label = F.lower(F.regexp_extract(F.coalesce(lang.cast("string"), F.lit("")), "^\\s*([A-Za-z]*)", 1))
    return F.when(label.isin(*NO_LANGUAGE), by_letters).otherwise(label.isin(*STOP_LANGUAGES))


def judgement(text: Column, rules: tuple[Rule, ...] = RULES, stop_language: Column | None = None) -> Column:
    """The figures of a text with ``base_failed``, ``failed_rules`` and ``kept``,
    as one struct, so that a filter on the verdict evaluates the figures once.
    ``stop_language`` says which texts the rules on stop words apply to (None: all)."""
    def breaks(rule: Rule, f: Column) -> Column:
        return ~rule.holds(f) if stop_language is None or not rule.stop_language else ~rule.holds(f) & stop_language

    def of(f: Column) -> Column:
        base_failed = (f["n_words"] < MIN_WORDS) | (f["n_repeat_words"] * 100 > f["n_words"] * MAX_REPEAT_PERCENT)
        broken = F.filter(F.array(*[F.when(breaks(r, f), F.lit(r.name)) for r in rules]), lambda r: r.isNotNull())
        return let(broken, lambda b: F.struct(
            *[f[n].alias(n) for n in FIGURES], base_failed.alias("base_failed"),
            (~base_failed & (F.size(b) == 0)).alias("kept"), F.array_join(b, ",").alias("failed_rules")))

    return let(figures(text), of)


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text passes every rule, with its own columns.

    ``lang`` is the column of language labels, if ``docs`` has it."""
    body = F.col(f"`{text}`")
    language = in_stop_language(body, F.col(f"`{lang}`") if lang in docs.columns else None)
    return docs.where(judgement(body, rules, language)["kept"])


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its figures, the base rule and the verdict."""
    judged = docs.select("doc_id", judgement(F.col("text"), rules).alias("j"))
    return judged.select("doc_id", *[F.col("j")[n].alias(n) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words", "n_upper", "failed_rules")])
