"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector, drawn from a generator seeded by its code point.
A trigram binds its letters: the first vector rotated twice, the second once, the
third as it is, multiplied element by element. A text bundles (adds) the vectors of
its trigrams; a language prototype bundles all texts of that language. A text gets
the language whose prototype has the largest cosine with it.

Bundling is linear, so tasks add whole-number vectors per language and Spark sums
them; one vector per language comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import over_arrow, table

DIMENSIONS = 1024
UNKNOWN = "und"
MAX_LANGUAGES = 10_000
PIECE = 1 << 20
SPACE = 32


def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dimensions, dtype=np.int8)
    return (2 * bits - 1).astype(np.float32)


class Bundler:
    """Adds up trigram vectors of texts."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.vectors: dict[int, np.ndarray] = {}
        self.is_letter = np.zeros(0x110000, bool)
        self.looked = np.zeros(0x110000, bool)
        self.rank = np.zeros(0x110000, np.int64)

    def _clean(self, text: str, after_letter: bool) -> tuple[np.ndarray, bool]:
        """Letters as code points, each run of others after a letter as one blank; whether the last is a letter."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for c in np.unique(codes[~self.looked[codes]]):
            self.looked[c], self.is_letter[c] = True, chr(c).isalpha()
        letter = self.is_letter[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        return np.where(letter, codes, SPACE)[keep].astype(np.int64), bool(letter[-1])

    def _pieces(self, text: str) -> Iterator[tuple[np.ndarray, int]]:
        """A text, blanks around, in pieces of bounded size and the letters of each.

        A piece begins with the last two code points of the one before, so that every
        trigram of the text lies in exactly one piece.
        """
        low, carried, after_letter = text.lower(), np.asarray([SPACE]), False
        for at in range(0, len(low), PIECE):
            body, after_letter = self._clean(low[at : at + PIECE], after_letter)
            end = [SPACE] if at + PIECE >= len(low) else []
            codes = np.concatenate([carried, body, np.asarray(end, np.int64)])
            yield codes, int((body != SPACE).sum())
            carried = codes[-2:]

    def _letters(self, alphabet: np.ndarray) -> np.ndarray:
        if len(self.vectors) > 4096:
            self.vectors.clear()
        for c in alphabet:
            if int(c) not in self.vectors:
                self.vectors[int(c)] = letter_vector(int(c), self.dimensions, self.seed)
        return np.stack([self.vectors[int(c)] for c in alphabet])

    def bundle(self, texts: list[tuple[int, str]], rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Vector sums and letter counts per row; ``texts`` are (row, text)."""
        total, letters = np.zeros((rows, self.dimensions)), np.zeros(rows, np.int64)
        parts, owner, held = [], [], 0
        for row, text in texts:
            for codes, seen in self._pieces(text):
                letters[row] += seen
                if len(codes) < 3:
                    continue
                parts.append(codes)
                owner.append(row)
                held += len(codes)
                if held >= PIECE:
                    self._add(total, parts, owner)
                    parts, owner, held = [], [], 0
        if parts:
            self._add(total, parts, owner)
        return total, letters

    def _add(self, total: np.ndarray, parts: list[np.ndarray], owner: list[int]) -> None:
        """Add the trigram vectors of pieces to the rows that own them."""
        rows = len(total)
        sizes = np.asarray([len(p) for p in parts])
        codes = np.concatenate(parts)
        alphabet = np.unique(codes) if len(codes) < 1000 else self._present(codes)
        self.rank[alphabet] = np.arange(len(alphabet))
        r, n = self.rank[codes], len(alphabet)
        gram = (r[:-2] * n + r[1:-1]) * n + r[2:]
        inside = np.ones(len(gram), bool)
        cut = np.cumsum(sizes)[:-1]
        inside[cut - 2] = inside[cut - 1] = False  # not across two texts
        who = np.repeat(np.asarray(owner), sizes)[:-2][inside]
        gram = gram[inside]
        if n**3 <= 1 << 23:
            there = np.zeros(n**3, bool)
            there[gram] = True
            grams = np.flatnonzero(there)
            index = np.zeros(n**3, np.int64)
            index[grams] = np.arange(len(grams))
            at = index[gram]
        else:
            grams, at = np.unique(gram, return_inverse=True)
        letter = self._letters(alphabet)
        twice, once = np.roll(letter, 2, axis=1), np.roll(letter, 1, axis=1)
        block = 2048
        for first in range(0, len(grams), block):
            g = grams[first : first + block]
            bound = twice[g // (n * n)]
            bound *= once[g // n % n]
            bound *= letter[g % n]
            mine = (at >= first) & (at < first + len(g)) if len(grams) > block else slice(None)
            counts = np.bincount(who[mine] * len(g) + at[mine] - first, minlength=rows * len(g)).reshape(rows, len(g))
            total += counts.astype(np.float32) @ bound

    def _present(self, codes: np.ndarray) -> np.ndarray:
        there = np.zeros(0x110000, bool)
        there[codes] = True
        return np.flatnonzero(there)


def _groups(texts: list[str | None], most: int = 128, chars: int = 600_000) -> Iterator[range]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and (i - first >= most or size + len(t or "") > chars):
            yield range(first, i)
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield range(first, len(texts))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept out of learning; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7) -> dict[str, np.ndarray]:
    """Unit prototype per language from all rows (text, lang); rows without either are left out.

    Float32 products of +-1 and counts below 2**24 and their float64 sums are whole
    numbers, so the result does not depend on the order of tasks.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(dimensions, seed), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            texts = [t.as_py() for t in batch.column(0)]
            for group in _groups(texts):
                known = sorted({langs[i] for i in group})
                row = {v: i for i, v in enumerate(known)}
                total, _ = bundler.bundle([(row[langs[i]], texts[i]) for i in group], len(known))
                for v, i in row.items():
                    sums[v] = sums[v] + total[i] if v in sums else total[i]
        for v, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([v]), pa.array([total.astype(np.int64)])], names=["lang", "total"])

    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    parts = rows.mapInArrow(add, "lang string, total array<bigint>")
    summed = parts.select("lang", F.posexplode("total").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    profiles = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("p"))
    found = profiles.select("lang", F.col("p.v").alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for r in sorted(found, key=lambda r: r["lang"]):
        v = np.asarray(r["v"], np.float64)
        if v.any():
            out[r["lang"]] = v / np.linalg.norm(v)
    return out


def identify(
    docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = (), dimensions: int = DIMENSIONS, seed: int = 7
) -> DataFrame:
    """``keep`` columns plus lang_pred and score (cosine, cut to 0..1) for each row's ``text``.

    A null text, one without a letter, or any text when nothing was learned is
    ``und`` with score 0. Ties go to the alphabetically first language. Repeated rows
    are predicted one by one.
    """
    names = list(prototypes)
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((0, dimensions))
    sent = docs.sparkSession.sparkContext.broadcast(matrix)
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    text = "text" if "text" in keep else "_text"
    state: dict = {}

    def predict(batch: pa.RecordBatch) -> Iterator[dict]:
        if not state:
            state["bundler"] = Bundler(dimensions, seed)
        texts = [t.as_py() for t in batch.column(text)]
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for group in _groups(texts):
            pairs = [(i - group.start, texts[i]) for i in group if texts[i]]
            total, letters = state["bundler"].bundle(pairs, len(group))
            size = np.linalg.norm(total, axis=1)
            cosine = total @ sent.value.T / np.where(size > 0, size, 1)[:, None]
            for i in np.flatnonzero(letters > 0) if len(names) else ():
                best = int(np.argmax(cosine[i]))
                lang[group.start + i], score[group.start + i] = names[best], min(1.0, max(0.0, float(cosine[i, best])))
        yield {c: batch.column(c) for c in keep} | {"lang_pred": lang, "score": score}

    # A text that is kept travels once.
    rows = docs.select(*keep) if text == "text" else docs.select(*keep, F.col("text").alias(text))
    return over_arrow(rows, predict, ", ".join([*kept, "lang_pred string, score double"]))


def op3_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    prototypes = learn_prototypes(docs.filter(~F.col("held_out")))
    return identify(docs, prototypes, keep=("doc_id", "held_out"))
