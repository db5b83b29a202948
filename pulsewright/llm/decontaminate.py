"""Benchmark decontamination with one FM-index per training shard.

A shard is a bounded run of documents inside a task. Its text becomes a string of
word symbols: words that occur in the benchmark get a number, all others are breaks,
because no test phrase holds them. The shard's index is the Burrows-Wheeler transform
of that string in a wavelet matrix, with suffix positions sampled at every 16th place
and at the start of each stretch. All test phrases are searched backward at once by
wavelet ranks; matching rows are walked to the nearest sampled suffix, which gives
their places; places merge into removal spans.

Phrases come in blocks of bounded size, each sent to the tasks as one broadcast. With
more than one block the documents are first stored with a row number, and the blocks'
findings are merged by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import over_arrow, stored, table

WINDOW = 10
SAMPLE = 16
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 16 << 20

# Bytes of words, A-Z lowered; everything else becomes a blank. In UTF-8 every byte
# of a character above 0x7F is 0x80 or more, so the byte table is exact.
_LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def phrase_words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.encode().translate(_LOWER).split() if text else []


class Phrases:
    """Distinct windows of a block of items, as symbol rows, and the items of each.

    Windows are rows of 32-bit symbols; the items of window ``w`` are
    ``names[i]`` for i in ``item[first[w]:first[w + 1]]``. A window costs some fixed
    number of bytes, no object of its own.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        self.names = sorted({i for i, _ in items if i is not None})
        number = {name: n for n, name in enumerate(self.names)}
        by_width: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            codes = np.asarray([self.symbol.setdefault(w, len(self.symbol) + 1) for w in phrase_words(text)], np.int32)
            if len(codes):
                by_width.setdefault(min(window, len(codes)), []).append((codes, number.get(item_id, -1)))
        widest = max(by_width, default=0)
        codes_, widths, item, counts = [np.zeros((0, widest), np.int32)], [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for width, held in sorted(by_width.items()):
            windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(c, width) for c, _ in held])
            owner = np.repeat(np.asarray([n for _, n in held], np.int32), [len(c) - width + 1 for c, _ in held])
            order = np.lexsort((owner, *windows.T))
            windows, owner = windows[order], owner[order]
            new = np.ones(len(windows), bool)
            new[1:] = (windows[1:] != windows[:-1]).any(axis=1)
            # An item counts once for a window; one without id is not listed.
            listed = owner >= 0
            listed[1:] &= new[1:] | (owner[1:] != owner[:-1])
            counts.append(np.bincount(np.cumsum(new)[listed] - 1, minlength=int(new.sum())))
            item.append(owner[listed])
            padded = np.zeros((int(new.sum()), widest), np.int32)
            padded[:, :width] = windows[new]
            codes_.append(padded)
            widths.append(np.full(len(padded), width, np.int64))
        self.code = np.concatenate(codes_)
        self.width = np.concatenate([np.zeros(0, np.int64), *widths])
        self.item = np.concatenate(item)
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    def items_of(self, window: int) -> list[str]:
        return [self.names[i] for i in self.item[self.first[window] : self.first[window + 1]]]

    def parts(self) -> tuple:
        """Plain values, which a broadcast can carry to workers without this package."""
        return self.symbol, self.width, self.code, self.names, self.item, self.first

    @classmethod
    def of(cls, parts: tuple) -> Phrases:
        made = cls([])
        made.symbol, made.width, made.code, made.names, made.item, made.first = parts
        return made


class _Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 2, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Index of a symbol string in which 0 is a break; breaks never match.

    ``text`` must end in a break.
    """

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = self._suffixes(text)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1))])
        bwt = text[order - 1]
        self.levels, self.zeros = [], []
        rows = bwt
        for level in range(max(1, int(text.max(initial=0)).bit_length()) - 1, -1, -1):
            ones = (rows >> level) & 1 == 1
            self.levels.append((level, _Bits(ones)))
            self.zeros.append(int(n - ones.sum()))
            rows = np.concatenate([rows[~ones], rows[ones]])
        # A break is never walked over: the places right behind breaks are sampled too.
        sampled = (order % SAMPLE == 0) | (bwt == 0)
        self.sampled, self.samples = _Bits(sampled), order[sampled]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; each break counts as a symbol of its own."""
        n = len(text)
        breaks = text == 0
        rank = text.astype(np.int64) + int(breaks.sum())
        rank[breaks] = np.arange(int(breaks.sum()))
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * np.int64(2 * n + 2 + int(text.max(initial=0))) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if int(new[-1]) == n - 1:
                return order
            step *= 2

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbols in the transform before each place, plus the level's base."""
        at = at.copy()
        for (level, bits), zeros in zip(self.levels, self.zeros, strict=True):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones)
        return at

    def _back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First-column place of the rows before ``at`` that extend to the left by symbol."""
        base = self._rank(symbol, np.zeros_like(at))
        return self.starts[symbol] + self._rank(symbol, at) - base

    def _symbol(self, at: np.ndarray) -> np.ndarray:
        at, symbol = at.copy(), np.zeros_like(at)
        for (level, bits), zeros in zip(self.levels, self.zeros, strict=True):
            one, ones = bits.get(at), bits.rank(at)
            symbol |= one.astype(np.int64) << level
            at = np.where(one, zeros + ones, at - ones)
        return symbol

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all phrases: (phrase, low row, high row) of those found."""
        which = np.arange(len(phrases.width))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.starts[-1])
        top = len(self.starts) - 2
        for back in range(phrases.code.shape[1]):
            at = phrases.width[which] - 1 - back
            going = at >= 0
            symbol = np.where(going, phrases.code[which, np.maximum(at, 0)], 0)
            there = symbol <= top
            symbol = np.where(there, symbol, 0)
            low = np.where(going, self._back(symbol, low), low)
            high = np.where(going & there, self._back(symbol, high), np.where(going, low, high))
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
            if not len(which):
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in the given rows."""
        place, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        todo, at = np.arange(len(rows)), rows.copy()
        while len(todo):
            done = self.sampled.get(at)
            place[todo[done]] = self.samples[self.sampled.rank(at[done])] + steps[todo[done]]
            todo, at = todo[~done], at[~done]
            at = self._back(self._symbol(at), at)
            steps[todo] += 1
        return place


def _stretches(codes: np.ndarray, shortest: int) -> np.ndarray:
    """Places of benchmark words in stretches long enough to hold a phrase."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (codes > 0).view(np.int8), [0]])))
    first, last = edge[::2], edge[1::2]
    keep = last - first >= shortest
    first, last = first[keep], last[keep]
    if not len(first):
        return np.empty(0, np.int64)
    size = last - first
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))


class Shard:
    """Documents gathered until the shard is full, then indexed and searched."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.shortest = int(phrases.width.min(initial=WINDOW))
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple[str | None, int]] = []
        self.codes: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.bytes = 0

    def add(self, text: str | None) -> None:
        words = phrase_words(text)
        lookup = self.phrases.symbol.get
        codes = np.fromiter((lookup(w, 0) for w in words), np.int64, len(words))
        self.rows.append((text, len(words)))
        at = _stretches(codes, self.shortest)
        if len(at):
            gaps = np.flatnonzero(np.diff(at) > 1) + 1
            self.codes.append(np.append(np.insert(codes[at], gaps, 0), 0))
            self.place.append(np.append(np.insert(at, gaps, -1), -1))
        else:
            self.codes.append(np.zeros(1, np.int64))
            self.place.append(np.full(1, -1, np.int64))
        self.bytes += 64 + 2 * len(text or "")

    def found(self) -> Iterator[tuple[str | None, int, list[tuple[int, int]], list[str]]]:
        """Per document: text, words, merged word spans [start, end), item ids."""
        if not self.rows:
            return
        spans: list[list] = [[] for _ in self.rows]
        items: list[set] = [set() for _ in self.rows]
        text = np.concatenate([np.zeros(1, np.int64), *self.codes])
        if len(text) > 1 + len(self.rows) and len(self.phrases.width):
            place = np.concatenate([np.full(1, -1, np.int64), *self.place])
            sizes = np.asarray([len(c) for c in self.codes])
            first = 1 + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            index = FMIndex(text)
            which, low, high = index.search(self.phrases)
            times = high - low
            rows = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(int(times.sum()))
            phrase = np.repeat(which, times)
            at = index.locate(rows)
            doc = np.searchsorted(first, at, side="right") - 1
            begin = place[at]
            for d, p in np.unique(np.stack([doc, phrase], 1), axis=0):
                items[d].update(self.phrases.items_of(p))
            order = np.lexsort([begin, doc])
            for d, b, e in zip(doc[order], begin[order], (begin + self.phrases.width[phrase])[order], strict=True):
                own = spans[d]
                if own and b <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], int(e))
                else:
                    own.append([int(b), int(e)])
        for (body, n), own, ids in zip(self.rows, spans, items, strict=True):
            yield body, n, [tuple(s) for s in own], sorted(ids)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; each removed span leaves one blank."""
    ends = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : ends[first][0]])
        at = ends[last - 1][1]
    return "".join([*out, text[at:]])


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>, cleaned string"


def _found_schema(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema], _FOUND])


def _search(docs: DataFrame, phrases: Phrases, keep: tuple[str, ...], text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(phrases.parts())
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = Shard(Phrases.of(sent.value)), []

        def flush() -> Iterator[pa.RecordBatch]:
            found = shard.found()
            for batch in held:
                n, spans, items, cleaned = [], [], [], []
                for _ in range(batch.num_rows):
                    body, words, own, ids = next(found)
                    n.append(words)
                    spans.append([{"start": a, "end": b} for a, b in own])
                    items.append(ids)
                    cleaned.append(without_spans(body, own) if own else None)
                results = [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pair)), pa.array(items, pa.list_(pa.string())), pa.array(cleaned, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], *results], names=[*keep, "n_words", "spans", "items", "cleaned"]
                )
            shard.clear()
            held.clear()

        for batch in batches:
            held.append(batch)
            for text in batch.column("_text"):
                shard.add(text.as_py())
            if shard.bytes >= SHARD_BYTES:
                yield from flush()
        yield from flush()

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, _found_schema(docs, keep))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in blocks of bounded size; an item is never split over blocks."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = items.agg(F.sum(size).alias("b")).first()["b"] or 0
    if total <= block_bytes:
        yield [tuple(r) for r in items.collect()]
        return
    # Equal items tell nothing new; others are dealt by hash, so that no task orders or holds them all.
    items = stored(items.distinct(), "phrase-items")
    blocks = -(-2 * total // block_bytes)
    while True:
        block = F.pmod(F.xxhash64("item_id", "text", F.lit(blocks)), F.lit(blocks))
        dealt = items.withColumn("_block", block)
        held = dealt.groupBy("_block").agg((F.sum(size) - F.max(size)).alias("rest"))
        # Next to its largest item a block holds less than block_bytes.
        if held.filter(F.col("rest") >= block_bytes).isEmpty():
            break
        blocks *= 2
    dealt = stored(dealt.repartition("_block").sortWithinPartitions("_block"), "phrases")
    for block in range(blocks):
        part = [tuple(r) for r in dealt.filter(F.col("_block") == block).drop("_block").collect()]
        if part:
            yield part


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    text_col: str = "text",
) -> DataFrame:
    """``keep``, n_words, spans (word ranges), items and cleaned text of every document.

    ``cleaned`` is null unless something is removed. A null or empty text has no
    words; a text or item without words matches nothing; an item with a null id
    removes words but is not listed; equal ids count once. Repeated rows are searched
    each. Other columns of either table are ignored.
    """
    blocks = _blocks(benchmark, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _search(docs, Phrases(first, window), keep, text_col)
    numbered = stored(docs.select(*keep, F.col(text_col).alias("_text"), F.monotonically_increasing_id().alias("_row")), "leak-rows")
    parts = []
    for block in (b for group in ([first, second], blocks) for b in group):
        hits = _search(numbered, Phrases(block, window), ("_row",), "_text").select("_row", "spans", "items")
        parts.append(stored(hits.filter(F.size("spans") > 0), "leak-hits"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items")
    )

    def clean(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {k: [] for k in ("n_words", "spans", "items", "cleaned")}
        for row in batch.select(["_text", "_spans", "_items"]).to_pylist():
            spans: list[list[int]] = []
            for s in sorted(row["_spans"] or [], key=lambda s: s["start"]):
                if spans and s["start"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], s["end"])
                else:
                    spans.append([s["start"], s["end"]])
            out["n_words"].append(len(phrase_words(row["_text"])))
            out["spans"].append([{"start": a, "end": b} for a, b in spans])
            out["items"].append(row["_items"] or [])
            out["cleaned"].append(without_spans(row["_text"], [tuple(s) for s in spans]) if spans else None)
        yield {c: batch.column(c) for c in keep} | out

    whole = numbered.join(merged, "_row", "left").select(*keep, "_text", "_spans", "_items")
    return over_arrow(whole, clean, _found_schema(docs, keep))


def op1_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return leaks.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, w[p:p + least(len(w), 10) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
hits AS (
  SELECT x.doc_id, x.p, bw.k, bw.item_id
  FROM (SELECT doc_id, p, k, w[p:p + k - 1] AS win
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)) x
  JOIN bw ON bw.k = x.k AND bw.win = x.win),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
