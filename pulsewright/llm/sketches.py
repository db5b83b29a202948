"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document's sketch holds the k smallest hash values of its shingles. Documents
   with the same shingle set are one class; only classes are compared.
2. For two sets that link, the k smallest values of the union show how much both share,
   so at least ``least_shared`` of the retained values are common, save with a
   probability of 1e-10 over the hash function (a set smaller than its sketch is known whole: no risk).
3. Inverted lists of retained values bring classes together. A class enters the lists of
   its rarest values only, as many as it takes to meet any partner; values of one class
   alone need no list. What can still match after a list's place bounds the overlap.
4. Pairs pass the estimate from the union's sketch and are verified once on whole sets.
5. A list of m classes would give m * m / 2 pairs. Classes are first compared with two
   of each list. Of lists that then still hold several components, whole sets are
   counted: a shingle found in one component only cannot be shared with another one, so
   what is left of a set bounds all its open links. Classes without enough left drop
   out, the others are compared with the class of each list that has most left. Last come all open pairs that still can link: they meet on the rarest
   shingles of their whole sets. Pairs left out lie in one component or cannot link.

Shingles are 64-bit hashes, as is the name of a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import WordHashes, mixed, over_arrow, small, stored, table
from pulsewright.llm.graph import connected_components
from pulsewright.llm.jaccard import shingle_sets

RETAINED = 64
# Probability, for one link, that its sketches share less than is asked for.
RISK = 1e-10
# Unions above this many shingles count as endless: draws with replacement spread wider.
ENDLESS = 5000
# The last round compares all open pairs, those before it only pairs with leaders.
ROUNDS = 2


@lru_cache(None)
def _quantile(union: int, percent: int, k: int) -> int:
    """Common values among the k smallest of a union, undercut with probability RISK at most."""
    share, below = percent / 100, 0.0
    common = union * percent // 100
    for x in range(k + 1):
        if union > ENDLESS:
            below += comb(k, x) * share**x * (1 - share) ** (k - x)
        else:
            below += comb(common, x) * comb(union - common, k - x) / comb(union, k)
        if below > RISK:
            return x
    return k


def least_shared(n: int, percent: int, k: int) -> int:
    """How many retained values a set of n shingles has in common with any set it links with."""
    exact = -(-percent * n // 100)
    union = 100 * n // percent
    return exact if union <= k else min(exact, _quantile(min(union, ENDLESS + 1), percent, k))


def _sketched(docs: DataFrame, size: int, percent: int, k: int) -> DataFrame:
    """Per document (doc_id, n, sig, need, sketch); the sketch in rising order."""
    from xxhash import xxh3_64_intdigest

    held = {}

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        hashes = held.setdefault("words", WordHashes())
        n, sig, need, sketch = [], [], [], []
        for grams in shingle_sets((t.as_py() for t in batch.column(1)), size, hashes):
            values = mixed(grams.view(np.uint64))
            if len(values) > k:
                values = np.partition(values, k - 1)[:k]
            n.append(len(grams))
            sig.append(xxh3_64_intdigest(grams.tobytes()))
            need.append(least_shared(len(grams), percent, k))
            # Signed values in the order of the unsigned ones.
            sketch.append((np.sort(values) ^ np.uint64(1 << 63)).view(np.int64))
        yield {"doc_id": batch.column(0), "n": n, "sig": np.asarray(sig, np.uint64).view(np.int64), "need": need, "sketch": sketch}

    return over_arrow(docs, run, "doc_id long, n long, sig long, need long, sketch array<long>")


def _postings(classes: DataFrame) -> DataFrame:
    """(value, sig, n, need, left) of the rarest retained values of each class that others have too.

    ``left`` is how many retained values can still be common when this is the first one that is.
    """
    lists = classes.select(F.explode("sketch").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("holders"))
    lists = stored(lists.filter("holders > 1"), "sketch-lists")
    each = classes.select("sig", "n", "need", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    common = each.join(small(lists, lists.count()), "value")
    # At most k entries for a class.
    own = common.groupBy("sig", "n", "need", "kept").agg(F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("own"))
    # Values that no other class has come first of all.
    placed = own.select("sig", "n", "need", F.size("own").alias("common"), F.posexplode("own").alias("at", "entry"))
    placed = placed.withColumn("left", (F.col("common") - F.col("at")).cast("long"))
    return placed.filter("left >= need").select("entry.value", "sig", "n", "need", "left")


def _may_link(percent: int) -> Column:
    n, m = F.col("n"), F.col("n2")
    length = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return length & (F.least("left", "left2") >= F.greatest("need", "need2"))


def _left_may_link(percent: int) -> Column:
    """Both sets have enough shingles left that another component holds too."""
    return (100 + percent) * F.least("open", "open2") >= percent * (F.col("n") + F.col("n2"))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("sig", "sig2").alias("a"), F.greatest("sig", "sig2").alias("b")).filter("a <> b").distinct()


def _with_leaders(postings: DataFrame, by: list[Column]) -> DataFrame:
    """Each posting with the classes of its list that have the greatest value of each of ``by``."""
    columns = [c for c in postings.columns if c != "value"]
    row = F.struct(*columns)
    leaders = postings.groupBy("value").agg(*[F.max_by(row, key).alias(f"_{i}") for i, key in enumerate(by)], F.count(F.lit(1)).alias("classes"))
    leaders = leaders.filter("classes > 1").withColumnRenamed("value", "_value")
    met = postings.join(leaders, F.col("value") == F.col("_value"))
    met = met.select(*columns, F.explode(F.array(*[f"_{i}" for i in range(len(by))])).alias("_l"))
    return met.select(*columns, *[F.col(f"_l.{c}").alias(f"{c}2") for c in columns])


def _estimated(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The pairs whose sizes and union sketch allow a link."""
    side = lambda s: classes.select(
        F.col("sig").alias(s), F.col("n").alias(f"n_{s}"), F.col("need").alias(f"need_{s}"), F.col("sketch").alias(f"sketch_{s}")
    )
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    return met.filter(shared >= F.greatest("need_a", "need_b")).select("a", "b", "n_a", "n_b")


class _WholeSets:
    """Shingle sets of classes, each read from its text once."""

    def __init__(self, docs: DataFrame, reps: DataFrame, size: int):
        self.docs, self.reps, self.size, self.have = docs, reps, size, None

    def of(self, sigs: DataFrame) -> DataFrame:
        """(sig, grams) of at least the given classes."""
        from xxhash import xxh3_64_intdigest

        size, held = self.size, {}

        def run(batch: pa.RecordBatch) -> Iterator[dict]:
            grams = list(shingle_sets((t.as_py() for t in batch.column("text")), size, held.setdefault("words", WordHashes())))
            names = np.asarray([xxh3_64_intdigest(g.tobytes()) for g in grams], np.uint64).view(np.int64)
            yield {"sig": names, "grams": grams}

        wanted = self.reps.join(sigs.select("sig").distinct(), "sig", "left_semi")
        if self.have is not None:
            wanted = wanted.join(self.have.select("sig"), "sig", "left_anti")
        wanted = stored(wanted.select(F.col("sig").alias("_sig"), "rep"), "sketch-wanted")
        asked = wanted.count()
        if asked or self.have is None:
            texts = self.docs.join(small(wanted.select("rep").distinct(), asked), F.col("doc_id") == F.col("rep"), "left_semi")
            # An id that repeats brings other texts along.
            found = over_arrow(texts, run, "sig long, grams array<long>").dropDuplicates(["sig"])
            found = stored(found.join(small(wanted, asked), F.col("sig") == F.col("_sig"), "left_semi"), "sketch-sets")
            self.have = found if self.have is None else self.have.unionByName(found)
        return self.have

    def verified(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs that link on whole sets."""
        have = self.of(pairs.select(F.explode(F.array("a", "b")).alias("sig")))
        side = lambda s: have.select(F.col("sig").alias(s), F.col("grams").alias(f"grams_{s}"))
        met = pairs.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("grams_a", "grams_b"))
        return met.filter((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _still_open(postings: DataFrame, components: DataFrame) -> DataFrame:
    """Postings, with components ``c``, of lists whose classes lie in several components."""
    named = postings.join(components, F.col("sig") == F.col("node"), "left")
    named = named.select("value", "sig", "n", "need", "left", F.coalesce("component", "sig").alias("c"))
    spread = named.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    return stored(named.join(spread.select("value"), "value", "left_semi"), "sketch-open")


def _left_open(rows: DataFrame, sets: _WholeSets, percent: int) -> DataFrame:
    """The rows of classes that can link with another component, with ``open`` shingles found in another one."""
    ids = rows.select("sig", "c").distinct()
    grams = sets.of(ids).join(ids, "sig").select("sig", "c", F.explode("grams").alias("gram"))
    spread = grams.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("gram")
    counted = grams.join(spread, "gram", "left_semi").groupBy("sig").agg(F.count(F.lit(1)).alias("open"))
    return stored(rows.join(counted, "sig").filter(100 * F.col("open") >= percent * F.col("n")), "sketch-left")


def _set_meetings(rows: DataFrame, sets: _WholeSets, percent: int) -> DataFrame:
    """Open pairs that can link, met on the rarest shingles of whole sets.

    A class's shingles are ordered from those no other component has to those most open
    classes have; a pair that links shares one early enough for the rest to suffice.
    """
    ids = rows.select("sig", "n", "c").distinct()
    grams = sets.of(ids).join(ids, "sig").select("sig", "n", "c", F.explode("grams").alias("gram"))
    holders = grams.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("holders"))
    shared = grams.join(holders.filter("lo <> hi").select("gram", "holders"), "gram")
    own = shared.groupBy("sig", "n", "c").agg(F.array_sort(F.collect_list(F.struct("holders", "gram"))).alias("own"))
    placed = own.select("sig", "n", "c", F.size("own").alias("open"), F.posexplode("own").alias("at", "entry"))
    placed = placed.withColumn("left", (F.col("open") - F.col("at")).cast("long")).filter(100 * F.col("left") >= percent * F.col("n"))
    one = placed.select("entry.gram", "sig", "n", "c", "left")
    two = one.select(*[F.col(c).alias(f"{c}2") for c in one.columns])
    n, m = F.col("n"), F.col("n2")
    enough = (100 + percent) * F.least("left", "left2") >= percent * (n + m)
    on = (F.col("gram") == F.col("gram2")) & (F.col("c") < F.col("c2")) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
    return one.join(two, on & enough)


def sketch_components(
    docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = RETAINED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link when 100 * |A and B| >= percent * |A or B| for their sets of word
    shingles (whole sets decide; sketches only propose); words are split at ASCII blanks
    and A-Z is lowered. The component is the smallest id reachable by links, and rows
    with that id are kept. A text without words (or null) has an empty set, links with
    nothing and is kept. A row with a null id gets its set size, no links, a null
    component and is kept. Rows that repeat an id count as documents of their own: equal
    rows with the smallest id are all kept, a different text with that id is judged by
    its own component. Extra columns are ignored; no documents give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stored(_sketched(rows, shingle, percent, k), "sketch-documents")
    linked = sketched.filter("n > 0 and doc_id is not null")
    classes = linked.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.any_value(F.struct("n", "need", "sketch")).alias("s"))
    classes = stored(classes.select("sig", "rep", "s.*"), "sketch-classes")
    reps = classes.select("sig", "rep")
    sets = _WholeSets(rows.filter("doc_id is not null"), reps, shingle)

    postings = stored(_postings(classes), "sketch-postings")
    by = [F.xxhash64("sig"), -F.xxhash64("sig").cast("decimal(20,0)")]
    tested = stored(_estimated(_pairs(_with_leaders(postings, by).filter(_may_link(percent))), classes, k), "sketch-pairs")
    links = stored(sets.verified(tested, percent), "sketch-links")
    components = stored(connected_components(links), "sketch-components")

    # In a list of two or three classes all are compared by now.
    wide = postings.groupBy("value").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 3")
    rest = postings.join(wide.select("value"), "value", "left_semi")
    for turn in range(1, ROUNDS + 1):
        rest = _still_open(rest.select("value", "sig", "n", "need", "left"), components)
        if rest.isEmpty():
            break
        if turn < ROUNDS:
            rest = _left_open(rest, sets, percent)
            most = F.struct(F.col("open") / F.col("n"), F.xxhash64("sig", F.lit(turn)))
            met = _with_leaders(rest, [most, F.xxhash64("sig", F.lit(turn))]).filter("c <> c2")
            met = met.filter(_may_link(percent) & _left_may_link(percent))
        else:
            met = _set_meetings(rest, sets, percent)
        fresh = _pairs(met).join(tested, ["a", "b"], "left_anti")
        fresh = stored(_estimated(fresh, classes, k), "sketch-pairs")
        if fresh.isEmpty():
            continue
        tested = tested.unionByName(fresh)
        links = links.unionByName(stored(sets.verified(fresh, percent), "sketch-links"))
        components = stored(connected_components(links), "sketch-components")

    grouped = reps.join(components, F.col("sig") == F.col("node"), "left")
    grouped = grouped.select("sig", "rep", F.coalesce("component", "sig").alias("c"))
    least = grouped.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, "c").select(F.col("sig").alias("_sig"), "component_id")
    found = sketched.select("doc_id", "n", "sig").join(named, F.col("sig") == F.col("_sig"), "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def op12_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_components(table(spark, sf_dir, "documents"), shingle=4, percent=80)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, w[p:p + least(len(w), 4) - 1] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS p FROM d WHERE len(w) > 0)),
g AS (SELECT dense_rank() OVER (ORDER BY g) AS g, doc_id FROM s),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""
