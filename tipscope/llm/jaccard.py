"""N-gram Jaccard join with adaptive multi-match prefixes.

1. Every text becomes its set of shingle hashes; texts of equal sets are one
   class, and only classes go on.
2. Multi-match prefix: in hash order, two sets of Jaccard similarity ``t``
   share at least ``l`` of the first ``n - ceil(t n) + l`` hashes of each, for
   any ``l``.  Every class starts with a short prefix (``l`` = SHORT percent
   of its size); a class with fewer hashes that occur elsewhere has no partner
   and leaves.  Where the estimated number of candidates of a class is high,
   its prefix is lengthened to ``l`` = LONG percent, and where it is still high
   to the whole set (``l`` = ``ceil(t n)``), and correspondingly more shared
   hashes are asked for.  A pair of different lengths meets at the shorter one.
3. Of the prefix hashes that occur elsewhere, the ``l - 1`` most frequent are
   left out of the index (a pair that shares ``l`` still meets in another one).
   A whole set of which ``m`` hashes occur elsewhere has partners of a size up
   to ``m (1 + t) / t - n`` only.
4. In every index bucket the most central class is compared with the others;
   what that links needs no further pairs.  The rest, classes outside their
   bucket's central component, meets everything of another component in its
   buckets.  Candidates pass a size bound and a parity sketch (512 parities of
   the set; the sketches of two sets differ in no more places than the sets
   do), both inside the join, then the shared prefix hashes are counted, then
   the whole sets are compared.
5. Links make connected components.

No step drops a pair that could link: every filter is a necessary condition.
Nothing but a few counts reaches the driver.

Edge cases: NULL and word-less texts have an empty set and link with nothing
(their component is their own id); a text with fewer words than the width has
one shingle, the whole sequence; NULL ids form a component id only if all ids
of the component are NULL; repeated rows fall into one class; extra columns
are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.components import connected_components
from tipscope.llm.pieces import release_encoders
from tipscope.llm.shingles import WordHasher, shingle_sets
from tipscope.llm.tables import Workspace, maybe_broadcast

#: Shared prefix hashes asked for, in percent of the set size.
SHORT, LONG = 6, 16
#: Level of the classes whose whole set is the prefix.
WHOLE = 100
#: A class expecting more candidates than this for each hash asked for gets the
#: long prefix; with more than this for each of its hashes, its whole set.
LENGTHEN_ABOVE, WHOLE_ABOVE = 8, 16
SKETCH_BITS = 512
#: Texts that a task hashes at once.
HASHED_ROWS = 256


def _needed(n: Column | int, percent: int):
    """ceil(percent * n / 100)."""
    return -((-percent * n) // 100) if isinstance(n, int) else F.ceil(n * percent / F.lit(100)).cast("int")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, which bounds the work arrays beside a batch."""
    return (batch.slice(at, HASHED_ROWS) for batch in batches for at in range(0, batch.num_rows, HASHED_ROWS))


def _signature(width: int, threshold: int):
    """Map function: set size, class key, parity sketch and long prefix of each text."""
    words = SKETCH_BITS // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        hasher = WordHasher()
        for batch in _parts(batches):
            sets = shingle_sets(batch["text"].to_pylist(), width, hasher)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            keys = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
            sketch = np.zeros((len(sets), words), np.int64)
            prefix = []
            for i, s in enumerate(sets):
                parity = np.bincount((s & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
                sketch[i] = np.packbits(parity.astype(np.uint8)).view(np.int64)
                size = len(s)
                prefix.append(s[:min(size, size - _needed(size, threshold) + max(1, _needed(size, LONG)))].view(np.int64))
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(keys[:, 0], pa.int64()), pa.array(keys[:, 1], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(sets) * words + 1, words, dtype=np.int32)), pa.array(sketch.ravel())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *prefix])))],
                ["doc_id", "n", "k", "k2", "sketch", "prefix"])

    return run


def _sets(width: int):
    """Map function: class key and whole sorted set of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in _parts(batches):
            sets = shingle_sets(batch["text"].to_pylist(), width, hasher)
            keys = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=16).digest()[:8], "little", signed=True) for s in sets]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *[s.view(np.int64) for s in sets]])))],
                ["k", "hashes"])

    return run


class JaccardJoin:
    """One run of the join; ``width`` words to a shingle, ``threshold`` percent."""

    def __init__(self, docs: DataFrame, width: int, threshold: int) -> None:
        self.width, self.threshold = width, threshold
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.ws, self.calls = Workspace(docs.sparkSession, "jaccard"), 0

    # sizes of prefixes and the numbers of shared hashes asked for

    def _ell(self, n: Column, percent: int) -> Column:
        return F.greatest(F.lit(1), _needed(n, percent))

    def _ell_least(self, n: Column, percent: int) -> Column:
        """The least that any possible partner of a set of this size asks for."""
        return self._ell(_needed(n, self.threshold), percent)

    def _prefix(self, n: Column, percent: int) -> Column:
        return F.least(n.cast("int"), n.cast("int") - _needed(n, self.threshold) + self._ell(n, percent))

    # steps

    def _classes(self) -> tuple[DataFrame, DataFrame]:
        signed = self.ws.save(self.docs.mapInArrow(
            _signature(self.width, self.threshold),
            "doc_id long, n long, k long, k2 long, sketch array<long>, prefix array<long>"), "signed")
        classes = self.ws.save(signed.where("n > 0").groupBy("k", "k2").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix")), "classes")
        members = self.ws.save(signed.select("doc_id", "n", "k", "k2"), "members")
        self.ws.drop("signed")
        return members, classes

    def _matched(self, tokens: DataFrame, name: str) -> DataFrame:
        """The (k, hash) rows whose hash occurs in two classes or more, with that number.

        The numbers are written before the join, so that adaptive execution can
        split a hash of very many classes in it."""
        df = self.ws.save(tokens.groupBy("hash").agg(F.count("*").alias("df")).where("df > 1"), f"{name}-numbers")
        rows = self.ws.save(tokens.join(df, "hash"), name)
        self.ws.drop(f"{name}-numbers")
        return rows

    def _least_shared(self, n: Column, level: int) -> Column:
        """What a class of this size must share at a level: with any possible partner
        in the prefix, or of its whole set."""
        return _needed(n, self.threshold) if level == WHOLE else self._ell_least(n, level)

    def _level(self, tokens: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        """Matched rows of the classes that reach a level, and per class that shares
        enough: ``n``, ``shared``, ``score``, and whether it goes on to the next level."""
        n = F.col("n")
        rows = self._matched(tokens, f"rows-{level}")
        kept = rows.groupBy("k", "n").agg(F.count("*").alias("shared"), F.sum(F.col("df") - 1).alias("cost")).where(
            F.col("shared") >= self._least_shared(n, level))
        on = {SHORT: F.col("cost") > self._ell(n, SHORT) * LENGTHEN_ABOVE, LONG: F.col("cost") > n * WHOLE_ABOVE, WHOLE: F.lit(False)}[level]
        return rows, self.ws.save(kept.select("k", "n", "shared", (F.col("cost") / n).alias("score"), on.alias("on")), f"kept-{level}")

    def _index_rows(self, rows: DataFrame, kept: DataFrame, level: int) -> DataFrame:
        """Index rows of a level: of the classes that stop here, and of those that go on
        but share enough with one that stops here.  Of a class's matched hashes the
        most frequent ones are left out, one less than it must share."""
        need = self._least_shared(F.col("n"), level)
        rows = rows.join(maybe_broadcast(kept.select("k", "shared", "on"), kept.count(), 40), "k")
        rank = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("df"), F.desc("hash")))
        chosen = rows.withColumn("rank", rank).where(F.col("rank") >= need)
        stopping = chosen.where("NOT on")
        if level != WHOLE:
            met = self.ws.save(rows.where("NOT on").select("hash").distinct(), f"met-{level}")  # written: see _matched
            mixed = rows.where("on").join(met, "hash", "left_semi").groupBy("k", "n").agg(F.count("*").alias("m")).where(F.col("m") >= need)
            stopping = stopping.unionByName(chosen.where("on").join(self.ws.save(mixed.select("k"), f"mixed-{level}"), "k", "left_semi"))
        # the largest partner that the matched hashes of a whole set allow
        most = F.floor(F.col("shared") * (100 + self.threshold) / F.lit(self.threshold)) - F.col("n") if level == WHOLE else F.lit(1 << 62)
        return stopping.select("hash", F.lit(level).alias("kind"), "k", "n", most.cast("long").alias("most"))

    def _prune(self, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The classes that may have a partner (``alive``), the index rows, and the whole
        sets that were needed for it."""
        n, ws = F.col("n"), self.ws
        short = classes.select("k", "n", F.explode(F.slice("prefix", 1, self._prefix(n, SHORT))).alias("hash"))
        rows, kept = self._level(short, SHORT)
        index = ws.save(self._index_rows(rows, kept, SHORT), f"index-{SHORT}")
        levels = kept.select("k", "score", F.lit(SHORT).alias("level"), "on")

        going = kept.where("on").select("k")
        tokens = classes.join(maybe_broadcast(going, kept.count(), 16), "k").select(
            "k", "n", F.explode(F.slice("prefix", 1, self._prefix(n, LONG))).alias("hash"))
        rows, kept = self._level(tokens, LONG)
        index = index.unionByName(ws.save(self._index_rows(rows, kept, LONG), f"index-{LONG}"))
        levels = levels.where("NOT on").unionByName(kept.where("NOT on").select("k", "score", F.lit(LONG).alias("level"), "on"))

        whole = ws.save(self._whole_sets(classes.join(kept.where("on").select("k"), "k", "left_semi")), "whole")
        rows, kept = self._level(whole.select("k", F.size("hashes").cast("long").alias("n"), F.explode("hashes").alias("hash")), WHOLE)
        last = ws.save(self._index_rows(rows, kept, WHOLE), "last")
        fitting = ws.save(last.groupBy("hash").agg(F.min("n").alias("least")), "fitting")
        last = last.join(fitting, "hash").where("least <= most").drop("least")  # some partner is small enough
        index = index.unionByName(ws.save(last, f"index-{WHOLE}"))
        levels = ws.save(levels.unionByName(kept.select("k", "score", F.lit(WHOLE).alias("level"), "on")), "levels")

        # classes that went on and left at a higher level stay for partners that stopped below
        named = index.select("k").distinct().join(levels.select("k", "level", "score"), "k", "left")
        alive = ws.save(named.select("k", F.coalesce("level", F.lit(WHOLE)).alias("level"), F.coalesce("score", F.lit(0.0)).alias("score")).join(
            classes.select("k", "n", "first_id", "sketch"), "k"), "alive")
        index = ws.save(index.join(maybe_broadcast(alive.select("k", "level", "score"), alive.count(), 40), "k"), "index")
        ws.drop(*[f"{t}-{level}" for t in ("rows", "kept", "mixed", "met", "index") for level in (SHORT, LONG, WHOLE)], "last", "fitting", "levels")
        return alive, index, whole

    def _may_link(self, a: str, b: str) -> Column:
        """Size bound and parity sketch of the classes with column prefixes a, b."""
        na, nb = F.col(f"{a}n"), F.col(f"{b}n")
        apart = sum((F.bit_count(F.col(f"{a}sketch")[i].bitwiseXOR(F.col(f"{b}sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
        t = self.threshold
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * t) & (apart * (100 + t) <= (na + nb) * (100 - t))

    def _whole_sets(self, classes: DataFrame) -> DataFrame:
        """(k, hashes) of some classes, one row each, from the texts of their first ids."""
        ids = classes.select(F.col("first_id").alias("doc_id")).distinct()
        ids = maybe_broadcast(ids, classes.count(), 16)
        chosen = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
        sets = chosen.mapInArrow(_sets(self.width), "k long, hashes array<long>").join(classes.select("k"), "k", "left_semi")
        self.calls += 1
        sets = self.ws.save(sets, f"sets-{self.calls}")
        if sets.count() > classes.count():  # repeated rows: an id that occurs more than once
            sets = self.ws.save(sets.dropDuplicates(["k"]), f"sets-{self.calls}-once")
        return sets

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (u, v) of classes that link, by their whole sets."""
        left = sets.select(F.col("k").alias("u"), F.col("hashes").alias("a"), F.col("level").alias("la"))
        right = sets.select(F.col("k").alias("v"), F.col("hashes").alias("b"), F.col("level").alias("lb"))
        a, b = F.col("a"), F.col("b")
        na, nb = F.size(a), F.size(b)

        def shares_prefix(percent: int) -> Column:
            both = F.array_intersect(F.slice(a, 1, self._prefix(na, percent)), F.slice(b, 1, self._prefix(nb, percent)))
            return F.size(both) >= self._ell(F.least(na, nb), percent)

        level = F.least("la", "lb")
        met = F.when(level == WHOLE, True).when(level == LONG, shares_prefix(LONG)).otherwise(shares_prefix(SHORT))
        common = F.size(F.array_intersect(a, b))
        return (pairs.join(left, "u").join(right, "v").where(met).where(common * 100 >= (na + nb - common) * self.threshold)
                .select("u", "v"))

    def _centres(self, index: DataFrame, name: str) -> DataFrame:
        """The most central class of every bucket; written before it is joined (see ``_matched``)."""
        return self.ws.save(index.groupBy("hash", "kind").agg(F.max_by("k", F.struct("score", "k")).alias("centre")), name)

    def _star_links(self, index: DataFrame, centres: DataFrame, alive: DataFrame, sets: DataFrame) -> DataFrame:
        pairs = index.join(centres, ["hash", "kind"]).where("k <> centre").select(
            F.least("k", "centre").alias("u"), F.greatest("k", "centre").alias("v")).distinct()
        side = lambda p, key: alive.select(F.col("k").alias(key), F.col("n").alias(f"{p}n"), F.col("sketch").alias(f"{p}sketch"))
        pairs = pairs.join(side("a", "u"), "u").join(side("b", "v"), "v").where(self._may_link("a", "b")).select("u", "v")
        return self._verified(pairs, sets)

    def _candidates(self, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The classes that may have a partner, the index, and their whole sets."""
        alive, index, whole = self._prune(classes)
        rest = self._whole_sets(alive.join(whole.select("k"), "k", "left_anti"))
        sets = whole.unionByName(rest).join(alive.select("k", "level"), "k")
        return alive, index, self.ws.save(sets, "sets")

    def links(self, classes: DataFrame) -> DataFrame:
        """Links between classes, enough of them to connect every component."""
        ws = self.ws
        alive, index, sets = self._candidates(classes)
        centres = self._centres(index, "centres-1")
        found = ws.save(self._star_links(index, centres, alive, sets), "star-1")
        label = ws.save(connected_components(found, ws, "label-1", rounds=2), "labels-1")
        outside = ws.save(self._outside(index, centres, label), "outside-1")
        found = found.unionByName(ws.save(self._star_links(outside, self._centres(outside, "centres-2"), alive, sets), "star-2"))
        label = ws.save(connected_components(found, ws, "label-2", rounds=2), "labels-2")

        # what is still outside its bucket's central component meets all of other components
        outside = ws.save(self._outside(index, centres, label), "outside-2")
        buckets = ws.save(outside.select("hash", "kind").distinct(), "buckets")
        every = index.join(buckets, ["hash", "kind"], "left_semi")
        labelled = alive.join(label.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("component", "k"))
        pairs = self._meetings(outside, every, labelled)
        closing = ws.save(self._verified(ws.save(pairs, "closing-pairs"), sets), "closing")
        ws.drop("index", "sets", "outside-1", "outside-2", "centres-1", "centres-2")
        return found.unionByName(closing)

    def _meetings(self, some: DataFrame, every: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs (u, v) of differently labelled classes of ``some`` and ``every`` that
        share an index row and may link; the filters work inside the join."""
        columns = ["hash", "kind", "n", "most", "level", "k", "sketch", "label"]
        attributes = classes.select("k", "sketch", "label")
        a = some.join(attributes, "k").select(*[F.col(c).alias(f"a{c}") for c in columns])
        b = every.join(attributes, "k").select(*[F.col(c).alias(f"b{c}") for c in columns])
        # a pair meets at the lower level of the two
        meet = ((F.col("ahash") == F.col("bhash")) & (F.col("akind") == F.col("bkind"))
                & (F.col("alabel") != F.col("blabel")) & (F.col("akind") == F.least("alevel", "blevel"))
                & (F.col("an") <= F.col("bmost")) & (F.col("bn") <= F.col("amost")))
        return (a.join(b.hint("merge"), meet & self._may_link("a", "b"))
                .select(F.least("ak", "bk").alias("u"), F.greatest("ak", "bk").alias("v")).distinct())

    def pairs(self) -> tuple[DataFrame, DataFrame]:
        """The join itself: every linked pair of classes, named by their smallest ids
        (``id_a`` < ``id_b``), and the membership (``doc_id``, ``class_id``) of all rows."""
        members, classes = self._classes()
        alive, index, sets = self._candidates(classes)
        found = self._verified(self._meetings(index, index, alive.withColumn("label", F.col("k"))), sets)
        name = lambda key, out: classes.select(F.col("k").alias(key), F.col("first_id").alias(out))
        named = found.distinct().join(name("u", "x"), "u").join(name("v", "y"), "v").select(
            F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
        own = members.join(classes.select("k", "k2", "first_id"), ["k", "k2"], "left")
        return named, own.select("doc_id", F.when(F.col("n") > 0, F.col("first_id")).otherwise(F.col("doc_id")).alias("class_id"))

    def _outside(self, index: DataFrame, centres: DataFrame, label: DataFrame) -> DataFrame:
        """Index rows whose class is not of the component of its bucket's centre."""
        centres = centres.join(label.select(F.col("node").alias("centre"), F.col("component").alias("c1")), "centre", "left")
        rows = index.join(label.select(F.col("node").alias("k"), F.col("component").alias("c2")), "k", "left")
        return rows.join(centres, ["hash", "kind"]).where(
            F.coalesce("c1", "centre") != F.coalesce("c2", "k")).select(*index.columns)

    def components(self) -> DataFrame:
        """``doc_id``, ``n_shingles``, ``component_id``, ``class_id`` (smallest id of
        equal sets) and ``class_size`` of every row."""
        ws = self.ws
        members, classes = self._classes()
        node = ws.save(connected_components(ws.save(self.links(classes), "links"), ws, "components"), "nodes")
        named = node.withColumnRenamed("node", "k").join(classes.select("k", "k2", "first_id"), "k")
        smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        linked = named.join(smallest, "component").select("k", "k2", "component_id")
        final = ws.save(classes.select("k", "k2", "first_id", "copies").join(linked, ["k", "k2"], "left").select(
            "k", "k2", F.coalesce("component_id", "first_id").alias("component_id"),
            F.col("first_id").alias("class_id"), F.col("copies").alias("class_size")), "final")
        ws.drop("classes", "alive")
        placed = members.where("n > 0").join(final, ["k", "k2"]).select(
            "doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", "class_size")
        empty = members.where("n = 0").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
            F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
        return placed.unionByName(empty)


def near_duplicate_components(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """Components of texts whose shingle sets have a Jaccard similarity of ``threshold`` percent or more."""
    return JaccardJoin(docs, width, threshold).components()


def keep_one_per_component(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """Of each component the rows of its smallest id stay; texts without words all stay.

    An id that stands for some component stays wherever it occurs, so repeated
    ids never empty a component.
    """
    ws = Workspace(docs.sparkSession, "near-dedup")
    found = ws.save(near_duplicate_components(docs, width, threshold).select("doc_id", "component_id"), "found")
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone_id")).distinct()
    stay = found.select(F.col("component_id").alias("stay_id")).distinct()
    gone = ws.save(gone.join(stay, F.col("gone_id").eqNullSafe(F.col("stay_id")), "left_anti"), "gone")
    side = maybe_broadcast(gone, gone.count(), 16)
    return docs.join(side, docs["doc_id"].cast("long").eqNullSafe(side["gone_id"]), "left_anti")
