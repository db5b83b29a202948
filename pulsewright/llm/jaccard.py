"""N-gram Jaccard self-join with rare-first prefix filtering.

1. Documents with the same shingle set are one class; only classes are compared.
2. Shingles are ordered rare first. Counting every shingle exactly would shuffle the
   whole corpus once per shingle, so frequencies are counted over all documents in a
   fixed number of hash buckets; any fixed order keeps the join exact.
3. Two sets that reach the threshold share a shingle among the first n - ceil(t n) + 1
   of both. The rows of a shingle meet in one shuffle, where those held by one class
   alone are dropped.
4. Candidates pass the length filter, the positional filter (what can still match
   after this place), and the suffix filter (partition sizes of both sets bound their
   difference), are made distinct and verified once on whole sets. Only sets in a pair
   are moved.
5. A group of m near copies would give m * m / 2 pairs. Classes are first compared
   with two leaders of each prefix shingle, some rounds with other leaders each time;
   then all pairs of a shingle that are still in different components are compared.
   Pairs left out lie in one component already, so components are exact.

Shingles are 64-bit hashes, as is the name of a class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.llm.common import GOLDEN, WordHashes, mixed, over_arrow, small, stored, table
from pulsewright.llm.graph import connected_components

BUCKET_BITS = 18
SHARED_BITS = 25
BINS, FINE_BINS = 32, 512
# Words hashed together, rows of an Arrow batch whose sets are held together, and words
# whose hashes a task remembers.
HELD_WORDS, HELD_ROWS, KNOWN_WORDS = 100_000, 1000, 200_000
# Rounds of leaders before all pairs that are still open are compared.
LEADER_ROUNDS = 4


def _rolled(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row."""
    grams = np.full(len(word) - k + 1, k, np.uint64)
    for i in range(k):
        grams = mixed(grams * GOLDEN + word[i : len(word) - k + 1 + i])
    return grams.view(np.int64)


def _distinct(grams: np.ndarray) -> np.ndarray:
    grams = np.sort(grams)
    new = np.empty(len(grams), bool)
    new[:1] = True
    np.not_equal(grams[1:], grams[:-1], out=new[1:])
    return grams[new]


def shingle_sets(texts: Iterable[str | None], size: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words the whole sequence is one.

    Texts are hashed together, ``HELD_WORDS`` words at a time.
    """
    words: list[list[bytes]] = []
    held = 0

    def sets() -> Iterator[np.ndarray]:
        flat = hashes(list(chain.from_iterable(words)))
        grams = _rolled(flat, size) if len(flat) >= size else flat[:0].view(np.int64)
        at = 0
        for own in words:
            n = len(own)
            if n >= size:
                yield _distinct(grams[at : at + n - size + 1])
            else:
                yield _rolled(flat[at : at + n], n) if n else np.empty(0, np.int64)
            at += n

    for text in texts:
        words.append(text.encode().lower().split() if text else [])
        held += len(words[-1])
        if held >= HELD_WORDS:
            yield from sets()
            words, held = [], 0
    yield from sets()


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, HELD_ROWS):
            yield batch.slice(at, HELD_ROWS)


def _needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles a set of n must share with any partner."""
    return -(-percent * n // 100)


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per document (doc_id, n, sig); per task one (bucket, times) row for each bucket seen."""
    from xxhash import xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(KNOWN_WORDS), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in _slices(batches):
            n, sig, buckets = [], [], [np.empty(0, np.int64)]
            for grams in shingle_sets((t.as_py() for t in batch.column(1)), size, hashes):
                buckets.append(grams & ((1 << BUCKET_BITS) - 1))
                n.append(len(grams))
                sig.append(xxh3_64_intdigest(grams.tobytes()))
            counts += np.bincount(np.concatenate(buckets), minlength=len(counts))
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(np.asarray(sig, np.uint64).view(np.int64)),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.int64()),
                ],
                names=["doc_id", "n", "sig", "bucket", "times"],
            )
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.int64())] * 3 + [pa.array(at.astype(np.int32)), pa.array(counts[at])],
            names=["doc_id", "n", "sig", "bucket", "times"],
        )

    return docs.mapInArrow(run, "doc_id long, n long, sig long, bucket int, times long")


def _prefixes(docs: DataFrame, size: int, percent: int, frequency: np.ndarray) -> DataFrame:
    """Per class: sig, n, its rare-first prefix, partition sizes. Copies within a task give one row."""
    from xxhash import xxh3_64_intdigest

    sent = docs.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, known = WordHashes(KNOWN_WORDS), set(), sent.value
        for batch in _slices(batches):
            sigs, sizes, prefixes, bins = [], [], [], []
            for grams in shingle_sets((t.as_py() for t in batch.column(1)), size, hashes):
                sig = xxh3_64_intdigest(grams.tobytes())
                if not len(grams) or sig in seen:
                    continue
                seen.add(sig)
                rare = np.argsort(known[grams & (len(known) - 1)], kind="stable")
                first = rare[: len(grams) - _needed(len(grams), percent) + 1]
                sigs.append(sig)
                sizes.append(len(grams))
                prefixes.append(grams[first])
                bins.append(np.bincount((grams >> 40) & (BINS - 1), minlength=BINS).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(sigs, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(bins, pa.list_(pa.int32())),
                ],
                names=["sig", "n", "prefix", "bins"],
            )

    return docs.mapInArrow(run, "sig long, n long, prefix array<long>, bins array<int>")


def bitmap_of(tokens: DataFrame, col: str, bits: int = SHARED_BITS) -> np.ndarray:
    """A bitmap of fixed size over the low bits of a column; whatever the rows, 2**bits bits come back."""
    at = F.col(col).bitwiseAND((1 << bits) - 1)
    word = F.shiftright(at, 6)
    bit = F.expr(f"shiftleft(1L, cast({col} & 63L as int))")
    words = tokens.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    rows = words.toArrow()
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _may_match(percent: int, one: Callable[[str], Column], two: Callable[[str], Column]) -> Column:
    """Length and positional filters on two rows of (n, pos)."""
    n, m = one("n"), two("n")
    length = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    rest = F.least(n - one("pos"), m - two("pos"))
    return length & ((100 + percent) * rest >= percent * (n + m))


def _leaders(seed: int, percent: int, other: str = "sig") -> Column:
    """Names of a token's two leaders, those with the smallest and largest scrambled name, that a row may match.

    Scrambling does not depend on the token: a group of near copies has the same
    leaders for all tokens it shares, which gives few pairs per class. A leader that
    is equal in column ``other`` is left out.
    """
    key, row = F.xxhash64("sig", F.lit(seed)), F.struct(*dict.fromkeys(("sig", "n", "pos", other)))
    of_token = Window.partitionBy("token")
    both = F.array(F.min_by(row, key).over(of_token), F.max_by(row, key).over(of_token))
    fits = F.filter(both, lambda l: (l.getField(other) != F.col(other)) & _may_match(percent, F.col, l.getField))
    return F.transform(fits, lambda l: l.getField("sig"))


def _postings(classes: DataFrame, percent: int) -> DataFrame:
    """(token, sig, n, pos, classes, met) of prefix shingles that more than one class holds.

    One shuffle brings the rows of a shingle together: copies of a class fold, its number
    of classes is counted and the leaders are found where it lies.
    """
    each = classes.select("sig", "n", F.posexplode("prefix").alias("pos", "token"))
    # A class met in several tasks: equal rows.
    rows = each.repartition("token").distinct()
    held = rows.withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("classes > 1")
    return held.withColumn("met", _leaders(0, percent))


def _pairs(sig: Column, other: Column, rows: DataFrame) -> DataFrame:
    return rows.select(F.least(sig, other).alias("a"), F.greatest(sig, other).alias("b")).filter("a <> b").distinct()


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of every class with the leaders of each of its prefix shingles."""
    return _pairs(F.col("sig"), F.col("sig2"), rows.select("sig", F.explode("met").alias("sig2")))


def _still_open(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Rows, with components ``c``, of shingles whose classes lie in several components; a shingle's rows lie together."""
    named = rows.join(small(components, components.count()), F.col("sig") == F.col("node"), "left").select(
        "token", "sig", "n", "pos", F.coalesce("component", "sig").alias("c")
    )
    of_token = Window.partitionBy("token")
    spread = named.repartition("token").withColumns({"_lo": F.min("c").over(of_token), "_hi": F.max("c").over(of_token)})
    return spread.filter("_lo <> _hi").drop("_lo", "_hi")


def _apart(one: Column | str, two: Column | str) -> Column:
    """How many shingles two sets differ in at least, by the sizes of their hash partitions."""
    return F.aggregate(F.zip_with(one, two, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)


def _close(percent: int, n: Column, m: Column, apart: Column) -> Column:
    # |A symmetric-difference B| = |A| + |B| - 2 |A and B|
    return (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _open_meetings(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(sig, sig2) of all classes on a shared prefix shingle that lie in different components and pass every filter.

    Partition sizes are compared where two rows meet: near copies just below the
    threshold share most shingles, and few of their pairs are ever listed.
    """
    rows = stored(rows.join(sizes.select("sig", "bins"), "sig"), "jaccard-open-bins")
    # Named by side and not by column, so that both sides read one shuffle.
    one, two = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    close = _close(percent, one("n"), two("n"), _apart(one("bins"), two("bins")))
    on = (one("token") == two("token")) & (one("c") < two("c")) & _may_match(percent, one, two) & close
    return rows.alias("x").join(rows.alias("y"), on).select(one("sig").alias("sig"), two("sig").alias("sig2"))


def _suffix_filtered(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Drop pairs whose sets differ too much by the sizes of their hash partitions."""
    side = lambda s: sizes.select(F.col("sig").alias(s), F.col("n").alias(f"n_{s}"), F.col("bins").alias(f"bins_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_close(percent, F.col("n_a"), F.col("n_b"), _apart("bins_a", "bins_b"))).select("a", "b", "n_a", "n_b")


class _Sets:
    """Whole shingle sets of the classes that occur in pairs, fetched once each."""

    def __init__(self, docs: DataFrame, reps: DataFrame, size: int):
        self.docs, self.reps, self.size, self.have = docs, reps, size, None

    def _fetch(self, sigs: DataFrame) -> DataFrame:
        from xxhash import xxh3_64_intdigest

        size, state = self.size, {}
        # A count cut off can only bring two sets closer.
        fine = lambda g: np.minimum(np.bincount((g >> 24) & (FINE_BINS - 1), minlength=FINE_BINS), 127).astype(np.int8)

        def sets(batch: pa.RecordBatch) -> Iterator[dict]:
            hashes = state.setdefault("hashes", WordHashes(KNOWN_WORDS))
            for part in _slices([batch]):
                grams = list(shingle_sets((t.as_py() for t in part.column("text")), size, hashes))
                names = np.asarray([xxh3_64_intdigest(g.tobytes()) for g in grams], np.uint64).view(np.int64)
                yield {"sig": names, "grams": grams, "fine": [fine(g) for g in grams]}

        ids = stored(self.reps.join(sigs, "sig", "left_semi").select("rep").distinct(), "jaccard-wanted")
        texts = self.docs.join(small(ids, ids.count()), F.col("doc_id") == F.col("rep"), "left_semi")
        return stored(over_arrow(texts, sets, "sig long, grams array<long>, fine array<tinyint>"), "jaccard-sets")

    def _met(self, pairs: DataFrame, col: str) -> DataFrame:
        """Pairs with a column of both sets.

        Where pairs are few, they go to the sets: only sets in a pair move, and only to the other side.
        """
        few = pairs.count()
        side = lambda s: self.have.select(F.col("sig").alias(s), F.col(col).alias(f"{col}_{s}"))
        partners = side("b").join(small(pairs.select("b").distinct(), few), "b", "left_semi")
        return side("a").join(small(pairs, few), "a").join(partners, "b")

    def verified(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs that reach the threshold on whole sets; finer partition sizes spare whole sets that are far apart."""
        sigs = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
        if self.have is None:
            self.have = self._fetch(sigs)
        else:
            missing = stored(sigs.join(self.have, "sig", "left_anti"), "jaccard-missing")
            if not missing.isEmpty():
                self.have = self.have.unionByName(self._fetch(missing))
        near = _close(percent, F.col("n_a"), F.col("n_b"), _apart("fine_a", "fine_b"))
        left = self._met(pairs, "fine").filter(near).select("a", "b", "n_a", "n_b").distinct()
        met = self._met(stored(left, "jaccard-near"), "grams")
        common = F.size(F.array_intersect("grams_a", "grams_b"))
        return met.filter((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b").distinct()


def jaccard_components(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * |A and B| >= percent * |A or B| for their sets of word
    shingles; words are split at ASCII blanks and A-Z is lowered. The component is the
    smallest id reachable by links. A text without words (or null) has an empty set and
    links with nothing. A row with a null id gets its set size, no links and a null
    component. Rows that repeat an id count as documents of their own; extra columns
    are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(_signatures(rows, shingle), "jaccard-signatures")
    counted = signed.filter("bucket is not null").groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    frequency = np.zeros(1 << BUCKET_BITS, np.int64)
    frequency[counted.column("bucket").to_numpy()] = counted.column("times").to_numpy()

    members = signed.filter("bucket is null").select("doc_id", "n", "sig")
    linked = members.filter("n > 0 and doc_id is not null")
    reps = stored(linked.groupBy("sig").agg(F.min("doc_id").alias("rep")), "jaccard-classes")

    named = rows.filter("doc_id is not null").select("doc_id", "text")
    classes = stored(_prefixes(named, shingle, percent, frequency), "jaccard-prefixes")
    postings = stored(_postings(classes, percent), "jaccard-postings")
    sizes = classes.groupBy("sig").agg(F.first("n").alias("n"), F.first("bins").alias("bins"))

    sets = _Sets(named, reps, shingle)
    tested = stored(_suffix_filtered(_leader_pairs(postings), sizes, percent), "jaccard-pairs")
    links = stored(sets.verified(tested, percent), "jaccard-links")
    components = stored(connected_components(links), "jaccard-components")
    # Two or three classes are all compared by now.
    rows = postings.filter("classes > 3")
    for seed in range(1, LEADER_ROUNDS + 1):
        rows = _still_open(rows, components)
        if seed < LEADER_ROUNDS:
            rows = stored(rows.withColumn("met", _leaders(seed, percent, "c")), "jaccard-open")
            pairs = _leader_pairs(rows)
        else:
            pairs = _pairs(F.col("sig"), F.col("sig2"), _open_meetings(rows, sizes, percent))
        fresh = pairs.join(tested, ["a", "b"], "left_anti")
        fresh = stored(_suffix_filtered(fresh, sizes, percent), "jaccard-pairs")
        if fresh.isEmpty():
            continue
        tested = tested.unionByName(fresh)
        links = links.unionByName(stored(sets.verified(fresh, percent), "jaccard-links"))
        components = stored(connected_components(links), "jaccard-components")

    grouped = reps.join(components, F.col("sig") == F.col("node"), "left").select(
        "sig", "rep", F.coalesce("component", "sig").alias("c")
    )
    least = grouped.groupBy("c").agg(F.min("rep").alias("component_id"))
    named_sig = grouped.join(least, "c").select(F.col("sig").alias("_sig"), "component_id")
    alone = F.col("n") == 0
    return members.join(named_sig, F.col("sig") == F.col("_sig"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Documents without their near copies: the smallest id of each component stays."""
    found = jaccard_components(docs, shingle, percent)
    gone = stored(found.filter("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
    return docs.join(small(gone, gone.count()), "doc_id", "left_anti")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


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
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""
