"""Mixing sources to target weights, in DataFrame functions only.

Temperature mixing: a source with token share ``p`` gets weight ``p ** x``,
normalised.  The exponent ``x`` in [0, 1] is found by bisection over sums of all
sources: the flattest mix (smallest ``x``) whose largest repetition keeps a
limit, or the mix that meets a target entropy.  However many sources there are,
only a few sums reach the driver.
Tokens are words between ASCII white space, or what a column of counts says.
A source of T tokens then has a budget of ``weight * total`` tokens, realised
as whole passes over its documents (epochs) and one partial pass.

A pass is a block permutation: the documents of a source are dealt by hash into
about sqrt(n) blocks, every pass orders blocks and documents anew by hash.  The
partial pass ends where its budget is spent.  That place is found from block
sums and the documents of one block per source, so no source, however large,
is ever ordered as a whole; and which documents the last pass holds is a
function of each row and its source's place, so rows are chosen where they lie.

Edge cases: a NULL source is a source of its own; NULL and word-less texts
count 0 tokens and appear once; a source without tokens has weight 0 and its
rows appear once; rows alike in id and text are taken or left together; empty
input gives an empty mix; extra columns of ``documents`` are kept by ``mixed``.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.quality import words_of
from tipscope.llm.tables import Workspace, let, maybe_broadcast

#: No source is repeated more often than this.
MAX_REPETITION = 1.5
#: Halvings of the exponent's range, and how many of them one aggregate decides.
BISECTIONS, SPLITS = 60, 5
_HASH_DIGITS = 13  # hex digits of md5 read as a number below 2 ** 52


def _hash(*parts: Column) -> Column:
    """52-bit number from the md5 of the parts, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, _HASH_DIGITS), 16, 10).cast("long")


def _identity(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))))


def _in_two(smallest: Column, largest: Column, max_repetition: float) -> Column:
    """Bisect the exponent for a repetition limit without a budget, in one expression.

    A source of size s is passed in proportion to s ** (x - 1), so the smallest
    and the largest source decide: their passes may differ by the limit."""
    def fine(exponent: Column) -> Column:
        return F.pow(largest / smallest, F.lit(1.0) - exponent) <= F.lit(float(max_repetition))

    def step(bounds: Column, _: Column) -> Column:
        return let((bounds["low"] + bounds["high"]) / 2, lambda mid: let(fine(mid), lambda ok: F.struct(
            F.when(ok, bounds["low"]).otherwise(mid).alias("low"), F.when(ok, mid).otherwise(bounds["high"]).alias("high"))))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")),
                        step, lambda bounds: bounds["high"])
    return F.when(fine(F.lit(0.0)), F.lit(0.0)).otherwise(found)


def _fine_at(sources: DataFrame, exponents: list[float], smallest: float, largest: float, n: int, budget: float | None,
             max_repetition: float | None, entropy: float | None) -> list[bool]:
    """Whether each exponent meets the target, from sums over all sources in one aggregate."""
    share = F.col("tokens") / F.lit(largest)
    powers = [F.pow(share, F.lit(x)) for x in exponents]
    sums = sources.agg(*[F.sum(p) for p in powers], *[F.sum(p * F.ln(share) * F.lit(x)) for p, x in zip(powers, exponents)]).first()
    out = []
    for k, x in enumerate(exponents):
        norm, logs = sums[k], sums[len(exponents) + k]
        if entropy is not None:  # -sum w ln w of w = p / norm, as a share of the greatest possible
            out.append(math.log(norm) - logs / norm <= entropy * math.log(n))
        else:
            out.append((smallest / largest) ** x / norm / smallest * budget <= max_repetition)
    return out


def solve_exponent(sources: DataFrame, budget: float | None, max_repetition: float | None, entropy: float | None) -> float | None:
    """The exponent for the sources of positive ``tokens``; None without any.

    Only sums, the smallest and the largest size are taken, never a list of
    sources.  With a budget or an entropy target the bisection goes SPLITS
    halvings at a time: one aggregate judges all exponents between."""
    sources = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("tokens"))
    smallest, largest, n = sources.agg(F.min("tokens"), F.max("tokens"), F.count("*")).first()
    if not n:
        return None
    if budget is None and entropy is None:
        one = sources.sparkSession.range(1).select(_in_two(F.lit(smallest), F.lit(largest), max_repetition).alias("x"))
        return round(one.first()["x"], 9)
    if _fine_at(sources, [0.0], smallest, largest, n, budget, max_repetition, entropy)[0]:
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS // SPLITS):
        between = [low + (high - low) * k / (1 << SPLITS) for k in range(1, 1 << SPLITS)]
        fine = [*_fine_at(sources, between, smallest, largest, n, budget, max_repetition, entropy), True]
        first = fine.index(True)
        low, high = (low, *between)[first], (*between, high)[first]
    return round(high, 9)


class Mix:
    """The plan of one mix: per source its weight, passes, and where the last pass ends."""

    def __init__(self, docs: DataFrame, budget: float | None = None, max_repetition: float | None = MAX_REPETITION,
                 entropy: float | None = None, seed: int = 42, tokens: str | None = None) -> None:
        """``tokens`` names a column of token counts (as of ``token_counts``); NULL counts 0."""
        if (max_repetition is None) == (entropy is None):
            raise ValueError("give either max_repetition or entropy")
        if budget is not None and not (budget > 0 and math.isfinite(budget)):
            raise ValueError("the budget is a positive number of tokens")
        self.docs, self.seed = docs, seed
        self.budget, self.max_repetition, self.entropy = budget, max_repetition, entropy
        self.ws = Workspace(docs.sparkSession, "mixing")
        measure = F.size(words_of(F.coalesce(F.col("text"), F.lit("")))) if tokens is None else F.coalesce(F.col(f"`{tokens}`"), F.lit(0))
        self.rows = self.ws.save(docs.select(
            F.col("doc_id"), F.col("source"), measure.cast("long").alias("n_tokens"),
            _identity(F.col("doc_id"), F.col("text")).alias("identity")), "rows")
        self.plan = self._plan()

    def _key(self, epoch: Column) -> Column:
        """Order of a document inside its block, in one pass."""
        return _hash(F.lit(f"{self.seed}:doc"), epoch.cast("string"), F.col("identity"))

    def _block_key(self, epoch: Column) -> Column:
        """Order of a block inside one pass of its source."""
        return _hash(F.lit(f"{self.seed}:block"), epoch.cast("string"), F.coalesce("source", F.lit("null")), F.col("block").cast("string"))

    def _block(self) -> Column:
        return _hash(F.lit(f"{self.seed}:deal"), F.col("identity")) % F.col("n_blocks")

    def _plan(self) -> DataFrame:
        by_source = self.ws.save(self.rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")), "sources")
        solved = solve_exponent(by_source, self.budget, self.max_repetition, self.entropy)
        positive = by_source.where("tokens > 0").select(F.col("tokens").cast("double").alias("s"))
        top = positive.agg(F.max("s")).first()[0] or 1.0
        power = F.pow(F.col("s") / F.lit(top), F.lit(solved if solved is not None else 1.0))
        norm, cover = (v if v is not None else 1.0 for v in positive.agg(F.sum(power), F.max(F.col("s") / power)).first())
        x, largest, norm, cover = (F.lit(float(v)) for v in (solved if solved is not None else 1.0, top, norm, cover))
        tokens = F.col("tokens").cast("double")
        weight = F.when(F.col("tokens") > 0, F.pow(tokens / largest, x) / norm).otherwise(0.0)
        total = cover * norm if self.budget is None else F.lit(float(self.budget))
        # passes are rounded so that a last-place difference of a power function moves no document
        sources = by_source.withColumn("exponent", x).withColumn("weight", weight).withColumn("passes", F.when(
            F.col("tokens") > 0, F.round(F.col("weight") * total / tokens, 6)).otherwise(1.0))
        sources = sources.select(
            "source", "tokens", "n_docs", "exponent", "weight", "passes", F.floor("passes").cast("int").alias("whole"),
            F.round((F.col("passes") - F.floor("passes")) * F.col("tokens")).cast("long").alias("rest"),
            F.ceil(F.sqrt("n_docs")).cast("long").alias("n_blocks"))
        sources = self.ws.save(sources, "weights")
        side = maybe_broadcast(sources.select("source", "whole", "rest", "n_blocks").withColumnRenamed("source", "s"), sources.count(), 100)

        # the block and then the document at which the last pass has spent its budget
        dealt = self.rows.join(side, F.col("source").eqNullSafe(F.col("s"))).where("rest > 0").withColumn("block", self._block())
        sums = dealt.groupBy("source", "whole", "rest", "block").agg(F.sum("n_tokens").alias("tokens"))
        sums = sums.withColumn("block_key", self._block_key(F.col("whole")))
        upto = Window.partitionBy("source").orderBy("block_key", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cut = sums.withColumn("upto", F.sum("tokens").over(upto)).where(
            (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("tokens") < F.col("rest"))).select(
            F.col("source").alias("cut_source"), F.col("block").alias("cut_block"), F.col("block_key").alias("cut_block_key"),
            (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest_in_block"))
        cut = self.ws.save(cut.groupBy("cut_source").agg(F.min(F.struct("cut_block_key", "cut_block", "rest_in_block")).alias("c")).select(
            "cut_source", "c.*"), "cut-blocks")
        cut_side = maybe_broadcast(cut, sources.count(), 60)
        last = dealt.join(cut_side, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("block") == F.col("cut_block")))
        last = last.withColumn("doc_key", self._key(F.col("whole")))
        spent = Window.partitionBy("source").orderBy("doc_key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        ends = last.withColumn("upto", F.sum("n_tokens").over(spent)).where("upto >= rest_in_block").groupBy("source").agg(
            F.min("doc_key").alias("cut_doc_key"))
        ends = ends.withColumnRenamed("source", "e")
        both = sources.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").join(
            ends, F.col("source").eqNullSafe(F.col("e")), "left")
        return self.ws.save(both.select(*sources.columns, "cut_block_key", "cut_block", "cut_doc_key"), "plan")

    def _copies(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with source and identity) plus ``block`` and an array of their passes."""
        n = self.plan.count()
        p = maybe_broadcast(self.plan.select(F.col("source").alias("s"), "whole", "rest", "n_blocks", "cut_block_key", "cut_block", "cut_doc_key"), n, 120)
        rows = rows.join(p, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", self._block())
        mine, key = self._block_key(F.col("whole")), self._key(F.col("whole"))
        ahead = F.struct(mine, F.col("block")) < F.struct(F.col("cut_block_key"), F.col("cut_block"))
        inside = (F.col("block") == F.col("cut_block")) & (key <= F.col("cut_doc_key"))
        partial = F.coalesce((F.col("rest") > 0) & (ahead | inside), F.lit(False))
        whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole") - 1)).otherwise(F.array().cast("array<int>"))
        return rows.withColumn("epochs", F.concat(whole, F.when(partial, F.array("whole")).otherwise(F.array().cast("array<int>"))))

    def stream(self) -> DataFrame:
        """One row per document and pass, with what orders it inside its source:
        ``epoch``, then ``block_key`` and ``block``, then ``doc_key``."""
        rows = self._copies(self.rows).select("doc_id", "source", "n_tokens", "identity", "block", F.explode("epochs").alias("epoch"))
        return rows.select("doc_id", "source", "n_tokens", "epoch", "block", self._block_key(F.col("epoch")).alias("block_key"),
                           self._key(F.col("epoch")).alias("doc_key"))

    def mixed(self) -> DataFrame:
        """The rows of the input, each as often as the mix holds it, with its own columns."""
        docs = self.docs
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        rows = docs.select(row, F.col("source").alias("source"), _identity(F.col("doc_id"), F.col("text")).alias("identity"))
        return self._copies(rows).select("row", F.explode("epochs").alias("epoch")).select("row.*")
