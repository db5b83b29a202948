"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Only lengths matter to a packing, and there are at most ``capacity`` different
ones. Spark counts them; the driver then packs the histogram, not the documents:

1. Reduction. For the longest open length j, a small set that dominates every other
   way to fill j's sequence is fixed for good: j alone if nothing fits beside it; j
   with an exact complement; j with the longest partner that fits, if no two or more
   of the remaining lengths can fill the rest better.
2. The shrunken instance is packed best-fit decreasing, whole counts at a time.

The plan is a list of runs "ranks a..b of length l go to sequences s.. at offset o".
Its size depends on the number of lengths, not of documents. Each piece gets an exact
rank within its length (per hash bucket, so that a common length is spread) and
looks its place up in the plan.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.llm.common import over_arrow, some_text, stored, table

CAPACITY = 4096
END_ID = 1
Run = tuple[int, int, int, int, int]  # length, first rank, count, first sequence, offset


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Parts(dict):
    """Ids of text parts by part, learnt when first asked for; ``old`` holds an earlier generation."""

    MARKS = ".,;:!?"
    LONGEST = 100

    def __init__(self, tokenizer: object, old: dict[str, bytes], letters: dict[int, str]):
        super().__init__({"": b""})
        self.tokenizer, self.model, self.old, self.letters = tokenizer, tokenizer.model, old, letters

    def __missing__(self, part: str) -> bytes:
        made = self.old.get(part)
        if made is None:
            word = part.rstrip(self.MARKS)
            lower = word.lower()
            # Marks after a letter that lower-cases to a letter and a mark would join that mark.
            if word == part or not lower.isalpha():
                made = self._word(part)
            else:
                made = self[lower if word.isascii() else word] + self[part[len(word) :]]
        if len(part) <= self.LONGEST:
            self[part] = made
        return made

    def _word(self, part: str) -> bytes:
        """A word of letters the model sees as they are needs neither normalising nor splitting."""
        if not part.isalpha():
            return self._whole(part)
        word = part.lower()
        if not word.isascii():
            if not self.letters.keys() >= set(map(ord, word)):
                return self._whole(part)
            word = word.translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()


class PackedTokens:
    """Token ids of texts as little-endian 32-bit bytes.

    This vocabulary drops white space, so a text's ids are those of its parts between
    blanks, one after the other, and closing marks after a word are parts of their own.
    Parts of up to 100 characters are remembered in two generations of ``limit`` each:
    when the younger is full it becomes the elder, and parts still in use move back.
    """

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        normal, split = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        # Latin letters that lower-casing and composing leave alone, as the model spells them.
        latin = [c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and c.lower() == c == normal(c)]
        self.letters = {ord(c): "".join(spelt for spelt, _ in split(c)) for c in latin}
        self.known = _Parts(self.tokenizer, {}, self.letters)

    @classmethod
    def of_worker(cls, path: str) -> PackedTokens:
        """The encoder of this Python worker, which outlives a task; words learnt by one serve the next."""
        kept = cls.__dict__.get("_kept")
        if kept is None or kept[0] != path:
            cls._kept = kept = (path, cls(path))
        return kept[1]

    def __call__(self, text: str) -> bytes:
        if len(self.known) > self.limit:
            self.known.old = {}
            self.known = _Parts(self.tokenizer, self.known, self.letters)
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, optionally ids."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    end = np.asarray([END_ID], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        encode = PackedTokens.of_worker(path)
        names = schema.replace(",", "").split()[::2]
        out: dict[str, list] = {n: [] for n in names}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = encode(text.as_py()) + end
            for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                row = [doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)]
                for name, value in zip(names, row, strict=False):
                    out[name].append(value)
                if with_ids:
                    out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
        yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), some_text(text_col).alias("text"))
    return over_arrow(rows, cut, schema)


class _Stock:
    """Open lengths with their counts and how many of each are already placed."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {k: v for k, v in histogram.items() if v > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.lengths = sorted(self.left)

    def take(self, length: int, n: int) -> int:
        """Remove ``n`` of a length; their first rank."""
        first = self.used[length]
        self.used[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))
        return first

    def largest_up_to(self, bound: int) -> int | None:
        at = bisect_left(self.lengths, bound + 1)
        return self.lengths[at - 1] if at else None


def _several_fit_better(lengths: list[int], partner: int, room: int) -> bool:
    """Whether two or more of the lengths could add up to more than partner, within room.

    Lengths count as available without limit: an answer of False is then safe.
    """
    if not lengths or 2 * lengths[0] > room:
        return False
    reach = 0  # bit s: s is a sum of one or more lengths
    mask = (1 << (room + 1)) - 1
    for w in (w for w in lengths if w <= room):
        step = (1 << w) & mask
        reach |= step | ((reach << w) & mask)
        shift = w
        while shift <= room:  # any number of copies, by doubling
            reach |= (reach << shift) & mask
            shift *= 2
    several = 0
    for w in (w for w in lengths if w <= room):
        several |= (reach << w) & mask
    return several >> (partner + 1) != 0


def reduce_by_dominance(stock: _Stock, capacity: int, sequence: int, runs: list[Run]) -> int:
    """Fix dominating sets, longest length first; the next free sequence number."""
    for j in sorted(stock.left, reverse=True):
        while j in stock.left:
            room = capacity - j
            n = stock.left[j]
            partner = stock.largest_up_to(room)
            if partner is not None and partner == j and n == 1:
                at = bisect_left(stock.lengths, j)
                partner = stock.lengths[at - 1] if at else None
            if partner is None:
                runs.append((j, stock.take(j, n), n, sequence, 0))
                sequence += n
                continue
            others = [w for w in stock.lengths if w <= room]
            if partner != room and _several_fit_better(others, partner, room):
                break
            pairs = n // 2 if partner == j else min(n, stock.left[partner])
            runs.append((j, stock.take(j, pairs), pairs, sequence, 0))
            runs.append((partner, stock.take(partner, pairs), pairs, sequence, j))
            sequence += pairs
    return sequence


def best_fit(stock: _Stock, capacity: int, sequence: int, runs: list[Run]) -> int:
    """Best-fit decreasing over whole counts; the next free sequence number."""
    open_groups: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, count)
    rooms: list[int] = []

    def opened(room: int, first: int, n: int) -> None:
        if room not in open_groups:
            open_groups[room] = []
            insort(rooms, room)
        open_groups[room].append((first, n))

    for length in sorted(stock.left, reverse=True):
        while length in stock.left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                n = -(-stock.left[length] // (capacity // length))
                opened(capacity, sequence, n)
                sequence += n
                continue
            room = rooms[at]
            first, n = open_groups[room].pop()
            if not open_groups[room]:
                del open_groups[room]
                rooms.pop(at)
            t = min(n, stock.left[length])
            runs.append((length, stock.take(length, t), t, first, capacity - room))
            if room > length:
                opened(room - length, first, t)
            if t < n:
                opened(room, first + t, n - t)
    return sequence


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that place every rank of every length, and the number of sequences."""
    runs: list[Run] = []
    stock = _Stock(histogram)
    sequence = reduce_by_dominance(stock, capacity, 0, runs)
    return runs, best_fit(stock, capacity, sequence, runs)


def _placed(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """Look up each (length, rank) in the plan."""
    table_ = np.asarray(sorted(runs) or [(0, 0, 0, 0, 0)], np.int64)
    lookup = pieces.sparkSession.sparkContext.broadcast(table_)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def look_up(batch: pa.RecordBatch) -> Iterator[dict]:
        known = lookup.value
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        # Runs are sorted by (length, first rank); a 20-bit length leaves 43 bits of rank.
        at = np.searchsorted((known[:, 0] << 43) | known[:, 1], (length << 43) | rank, side="right") - 1
        run = known[at]
        yield {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")} | {
            "sequence_id": run[:, 3] + rank - run[:, 1],
            "offset": run[:, 4],
        }

    return over_arrow(pieces, look_up, schema)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    buckets: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    A null or empty text is one piece holding the end id alone. Longer documents than
    a sequence are cut, no other is. Repeated rows and null ids are packed as rows of
    their own; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer or tokenizer_file(), capacity, id_col, text_col), "pack-pieces")
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most capacity x buckets rows.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    first = counts.withColumn("before", before)
    # At most one row per possible length.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(histogram, capacity)
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = spread.withColumn("inside", F.row_number().over(inside) - 1).join(first, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).cast("long").alias("rank")
    )
    return _placed(ranked, runs)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
