"""Substring dedup by recompression.

A text's words become symbols, and rounds replace runs of a symbol and pairs of
neighbours by new symbols. A new symbol's name is a hash of what it replaces, so it is
the same in every text of the corpus without a shared dictionary. Which neighbours
form a pair is decided by the two symbols alone (a hashed bit says left or right), so
equal substrings get equal symbols inside.

Each symbol carries the span of words that its making depended on. A window of
``window`` words is anchored by its first symbol of the highest level that depends on
nothing outside the window; symbols of level 0 are single words, so there always is
one. The anchor is a function of the window's words: windows that are equal have equal
anchors, and nothing is missed. Spark counts anchors over all texts (a text has one for every 7
words or so) and only windows whose anchor occurs in two different texts are hashed
whole, grouped by hash, and compared by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import GOLDEN, WordHashes, mixed, over_arrow, stored, table, white_words
from pulsewright.llm.jaccard import bitmap_of, in_bitmap

WINDOW = 50
ROUNDS = 7
RUN_ROUNDS = (0, 3)
BATCH_WORDS = 250_000
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


class Symbols:
    """One level: names, and the first and last word each one depends on. Gaps part texts."""

    def __init__(self, name: np.ndarray, gap: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.name, self.gap, self.first, self.last = name, gap, first, last

    def runs(self, tag: int) -> Symbols:
        """Replace each maximal run by one symbol; where it ends is told by both neighbours."""
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | self.gap[1:] | self.gap[:-1]
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(self.name)))
        end = start + length - 1
        name = self.name[start]
        many = length > 1
        name[many] = mixed(name[many] * GOLDEN + length[many].astype(np.uint64) + np.uint64(tag << 32))
        gap = self.gap[start]
        first = np.where(gap, self.first[start], self.first[np.maximum(start - 1, 0)])
        last = np.where(gap, self.last[end], self.last[np.minimum(end + 1, len(self.last) - 1)])
        return Symbols(name, gap, first, last)

    def pairs(self, tag: int) -> Symbols:
        """Join a left symbol with a right one behind it."""
        n = len(self.name)
        right = mixed(self.name + np.uint64(tag)) >> np.uint64(63) != 0
        left, right = ~right & ~self.gap, right & ~self.gap
        joins = np.zeros(n, bool)
        joins[:-1] = left[:-1] & right[1:]
        joined = np.zeros(n, bool)
        joined[1:] = joins[:-1]
        name, first, last = self.name.copy(), self.first.copy(), self.last.copy()
        at = np.flatnonzero(joins)
        name[at] = mixed(self.name[at] * GOLDEN + mixed(self.name[at + 1]) + np.uint64(tag))
        # A left symbol depends on what follows, a lone right one on what is before.
        at = np.flatnonzero(left)
        last[at] = self.last[np.minimum(at + 1, n - 1)]
        at = np.flatnonzero(right & ~joined)
        first[at] = self.first[np.maximum(at - 1, 0)]
        keep = ~joined
        return Symbols(name[keep], self.gap[keep], first[keep], last[keep])


def recompress(words: np.ndarray, gap: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    at = np.arange(len(words), dtype=np.int64)
    levels = [Symbols(words, gap, at, at)]
    for r in range(rounds):
        now = levels[-1]
        if r in RUN_ROUNDS:
            now = now.runs(2 * r + 1)
        levels.append(now.pairs(2 * r + 2))
    return levels


def window_anchors(words: np.ndarray, gap: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, anchor name) of every window that lies inside one text."""
    gaps = np.concatenate([[0], np.cumsum(gap)])
    start = np.flatnonzero(gaps[window:] == gaps[:-window]) if len(words) >= window else np.empty(0, np.int64)
    anchor = np.zeros(len(start), np.uint64)
    levels = recompress(words, gap)
    todo = np.arange(len(start))
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        p = start[todo]
        j = np.minimum(np.searchsorted(level.first, p), len(level.first) - 1)
        inside = (level.first[j] >= p) & (level.last[j] < p + window)
        anchor[todo[inside]] = level.name[j[inside]] + np.uint64(depth)
        todo = todo[~inside]
        if not len(todo):
            break
    return start, mixed(anchor)


class WindowHashes:
    """Hashes of whole windows from running sums of words times powers of an odd base."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, base: int, n: int) -> np.ndarray:
        steps = np.full(n, base & (1 << 64) - 1, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def __call__(self, words: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
        if len(self.power) <= len(words):
            self.power = self._powers(_BASE, 2 * len(words) + 1)
            self.inverse = self._powers(_INVERSE, 2 * len(words) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.power[: len(words)], dtype=np.uint64)])
        return mixed((total[start + window] - total[start]) * self.inverse[start])


def _batches(rows: Iterator[tuple], hashes: WordHashes, window: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of (key..., text) rows with at least a window of words: keys, words, gaps, first word of each."""

    def joined() -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        size = np.asarray([len(p) for p in parts])
        # Each text stands between gaps.
        words = np.zeros(int(size.sum()) + len(parts) + 1, np.uint64)
        first = 1 + np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        gap = np.ones(len(words), bool)
        for f, p in zip(first, parts, strict=True):
            words[f : f + len(p)] = p
            gap[f : f + len(p)] = False
        return keys, words, gap, first

    keys, parts, held = [], [], 0
    for *key, text in rows:
        words = white_words(text)
        if len(words) < window:
            continue
        parts.append(hashes(words))
        keys.append(tuple(key))
        held += len(words)
        if held >= BATCH_WORDS:
            yield joined()
            keys, parts, held = [], [], 0
    if parts:
        yield joined()


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """(name, th) of every anchor of every text; copies inside a task count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()

        def fresh() -> Iterator[tuple]:
            for batch in batches:
                for th, text in zip(batch.column("th").to_pylist(), batch.column("text"), strict=True):
                    if th not in seen:
                        seen.add(th)
                        yield th, text.as_py()

        for keys, words, gap, first in _batches(fresh(), hashes, window):
            start, anchor = window_anchors(words, gap, window)
            doc = np.searchsorted(first, start, side="right") - 1
            new = np.ones(len(start), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            th = np.asarray([k[0] for k in keys], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new].view(np.int64)), pa.array(th[doc[new]])], names=["name", "th"]
            )

    return rows.select("th", "text").mapInArrow(run, "name long, th long")


def _windows(rows: DataFrame, window: int, shared: np.ndarray) -> DataFrame:
    """(h, doc_id, th, p) of every window with a shared anchor.

    A text that repeats inside a task is listed again only for a smaller id.
    """
    sent = rows.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, whole, least = WordHashes(), WindowHashes(), {}

        def fresh() -> Iterator[tuple]:
            for batch in batches:
                ids, names = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
                texts = batch.column("text")
                for i in sorted(range(len(ids)), key=ids.__getitem__):
                    if names[i] not in least or ids[i] < least[names[i]]:
                        least[names[i]] = ids[i]
                        yield ids[i], names[i], texts[i].as_py()

        for keys, words, gap, first in _batches(fresh(), hashes, window):
            start, anchor = window_anchors(words, gap, window)
            hit = in_bitmap(sent.value, anchor.view(np.int64))
            start = start[hit]
            doc = np.searchsorted(first, start, side="right") - 1
            key = np.asarray(keys, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(whole(words, start, window).view(np.int64)),
                    pa.array(key[doc, 0]),
                    pa.array(key[doc, 1]),
                    pa.array((start - first[doc]).astype(np.int32)),
                ],
                names=["h", "doc_id", "th", "p"],
            )

    named = rows.filter("doc_id is not null").select("doc_id", "th", "text")
    return named.mapInArrow(run, "h long, doc_id long, th long, p int")


def _removed(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, th, copy, starts): documents to change. ``copy`` marks a whole text with a smaller id elsewhere."""
    names = _anchors(rows, window).groupBy("name").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).filter("lo <> hi")
    shared = bitmap_of(names, "name")
    windows = stored(_windows(rows, window, shared), "repeat-windows")
    least = windows.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    # Stored: the join then deals out both sides anew, and a hash with very many windows can be split.
    least = stored(least.select("h", "least"), "repeat-least")
    met = windows.join(least, "h").filter("doc_id > least")
    starts = met.groupBy("doc_id", "th").agg(F.collect_list("p").alias("starts"))

    ids = stored(rows.filter("doc_id is not null").select("doc_id", "th"), "repeat-ids")
    texts = ids.groupBy("th").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    copies = ids.join(texts, "th").filter("doc_id > least").select("doc_id", "th").distinct().withColumn("copy", F.lit(True))
    return copies.join(starts, ["doc_id", "th"], "full_outer")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (words joined by a blank).

    A word goes if a window of ``window`` words that covers it also starts in a document
    with a smaller id. Words are split at ASCII blanks. A null text has no words; texts
    shorter than a window lose nothing. A row with a null id neither loses words nor
    counts as an earlier document; rows with equal ids do not repeat each other. Extra
    columns are ignored. Texts and windows are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    removed = stored(_removed(rows, window), "repeat-starts")
    whole = rows.join(removed, ["doc_id", "th"], "left").select("doc_id", "text", "copy", "starts")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept")}
        copies, lists = batch.column("copy").to_pylist(), batch.column("starts")
        for i, (doc_id, body) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
            words = white_words(body.as_py())
            hit = np.zeros(len(words) + 1, np.int64)
            if copies[i] and len(words) >= window:
                hit[0] = 1
            elif lists[i].is_valid:
                starts = lists[i].values.to_numpy()
                np.add.at(hit, starts, 1)
                np.add.at(hit, starts + window, -1)
            gone = np.cumsum(hit)[:-1] > 0
            if gone.any():
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out["doc_id"].append(doc_id)
            out["n_words"].append(len(gone))
            out["n_removed"].append(int(gone.sum()))
            out["kept"].append(b" ".join(words).decode())
        yield out

    return over_arrow(whole, cut, "doc_id long, n_words long, n_removed long, kept string")


def op8_recompression_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM win JOIN least USING (h) WHERE doc_id > m),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, (coalesce(len(d.w), 0) - coalesce(kept.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
