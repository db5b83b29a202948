"""Word divergence between the sources of a language, by one-hot level products.

How often a source uses a word is a level of the word in that source, and the price
of two levels depends on nothing else. So all that a pair of sources needs is its
joint table: how many words have level a in one and level b in the other. With one
indicator column for each (source, level) and one row for each word, the matrix
product of the columns' transpose with the columns holds the joint tables of all pairs.

The matrix is cut into blocks of words (by size of their count, then by hash; words of
like frequency have few levels) and blocks of 64 sources. A cell is one block of words
and two blocks of sources. Inside it the product is taken over pieces of words with at
most about a thousand columns, as 0/1 in float32: sums stay below 2**24 and are exact.
Tables of all cells add up. The level 0 is a column as well, so each pair's table holds
every word of its blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.llm.common import small, stored, table

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
# Words of a block on average, sources of a block, columns of one product.
BLOCK_TERMS = 1024
BLOCK_SOURCES = 64
PRODUCT_COLUMNS = 1024
# Entries a task holds before it passes its counts on.
HELD_ENTRIES = 250_000

LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lowered, as UTF-8."""
    return text.encode().translate(LETTERS).split() if text else []


def _partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) as far as each task counts; a null term names the group itself."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def emitted(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            words = [None, *(w.decode() for w in n)]
            columns = [[lang] * len(words), [source] * len(words), words, [0, *n.values()], [0, *map(docs.__getitem__, n)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                words = terms(text.as_py())
                n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                n.update(words)
                docs.update(set(words))
            if sum(len(n) for n, _ in held.values()) > HELD_ENTRIES:
                yield from emitted(held)
                held = {}
        yield from emitted(held)

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _price(count: str | Column, total: str, kept: str) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * kept)), null without kept terms; exact at any size."""
    wide = lambda c: c.cast("decimal(19,0)")
    count = F.col(count) if isinstance(count, str) else count
    over = F.nullif(F.col(total) + SMOOTHING * F.col(kept), F.lit(0).cast("long"))
    scaled = F.lit(SCALE).cast("decimal(10,0)") * wide(count + SMOOTHING)
    return 1 + F.call_function("div", scaled, wide(over))


class _Counts:
    """Stored counts: kept terms of each group, and the totals of groups."""

    def __init__(self, docs: DataFrame, min_docs: int):
        parts = stored(_partial_counts(docs), "divergence-partial")
        # Both levels read one shuffle.
        dealt = parts.filter("term is not null").repartition("lang", "term")
        of_group = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        of_lang = of_group.groupBy("lang", "term").agg(F.sum("docs").alias("lang_docs"), F.sum("n").alias("lang_n"))
        self.kept = stored(of_group.join(of_lang.filter(F.col("lang_docs") >= min_docs), ["lang", "term"]), "divergence-kept")

        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        # A term's total is the same in each of its rows; its first source stands for it.
        first = self.kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        langs = first.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
        groups = parts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.fillna(0, ["total", "kept", "lang_total"])
        no = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        last = F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1
        self.groups = stored(groups.withColumns({"no": no, "last": last}), "divergence-groups")
        self.size = self.groups.count()

    def priced(self) -> DataFrame:
        """Kept terms with ``p`` of the group and ``q`` of the language."""
        rows = self.kept.join(small(self.groups, self.size), ["lang", "source"])
        return rows.withColumns({"p": _price("n", "total", "kept"), "q": _price("lang_n", "lang_total", "kept")})


def _cells(counts: _Counts) -> DataFrame:
    """Entries of the indicator matrix, dealt to the cells they take part in.

    Each cell also gets one entry with a null term and level 0 for every source of its blocks.
    """
    bits = F.length(F.bin("lang_n"))
    entries = counts.priced().withColumn("bits", bits)
    blocks = counts.kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang", bits.alias("bits"))
    blocks = blocks.agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_TERMS)).alias("parts"))
    blocks = stored(blocks, "divergence-blocks")
    sized = small(blocks, blocks.count())
    part = F.pmod(F.xxhash64("term"), F.col("parts"))
    rows = entries.join(sized, ["lang", "bits"]).withColumn("part", part)
    zero = sized.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).join(counts.groups, "lang")
    zero = zero.withColumns({"term": F.lit(None).cast("string"), "n": F.lit(0).cast("long")})
    zero = zero.withColumn("p", _price("n", "total", "kept"))

    columns = ["lang", "bits", "part", "no", "term", "n", "p"]
    own = F.floor(F.col("no") / F.lit(BLOCK_SOURCES)).cast("int")
    last = F.floor(F.col("last") / F.lit(BLOCK_SOURCES)).cast("int")
    both = rows.select(*columns, own.alias("own"), last.alias("last")).unionByName(
        zero.select(*columns, own.alias("own"), last.alias("last"))
    )
    other = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    return other.select(*columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _pieces(by_word: list[np.ndarray], limit: int) -> Iterator[list[np.ndarray]]:
    """Runs of words, each an array of its columns, with at most ``limit`` columns or of one word."""
    work = [by_word]
    while work:
        part = work.pop()
        if len(part) == 1 or len(np.unique(np.concatenate(part))) <= limit:
            yield part
        else:
            work += [part[: len(part) // 2], part[len(part) // 2 :]]


def joint_tables_of_cell(cell: pa.Table, i: int, j: int) -> Iterator[tuple]:
    """Per piece of words: (product, left columns, right columns), a column being (source number, level, price).

    The product counts words: entry (x, y) is how many have the level of column x and the level of column y.
    """
    no, n, p = (cell.column(c).to_numpy() for c in ("no", "n", "p"))
    order = np.lexsort((n, no))
    new = np.ones(len(order), bool)
    new[1:] = (no[order][1:] != no[order][:-1]) | (n[order][1:] != n[order][:-1])
    code = np.empty(len(order), np.int64)
    code[order] = np.cumsum(new) - 1
    # By column: its source, level and price.
    level = [a[order][new] for a in (no, n, p)]
    words = cell.column("term").combine_chunks().dictionary_encode().indices
    row = words.fill_null(-1).to_numpy()
    zeros = np.sort(code[row < 0])
    zero_of = dict(zip(level[0][zeros].tolist(), zeros.tolist()))

    held = np.flatnonzero(row >= 0)
    if not len(held):
        return
    held = held[np.argsort(row[held], kind="stable")]
    by_word = np.split(code[held], np.flatnonzero(np.diff(row[held])) + 1)
    # Words of like counts next to each other share columns.
    by_word.sort(key=lambda codes: level[1][codes].sum())
    for piece in _pieces(by_word, PRODUCT_COLUMNS):
        flat = np.concatenate(piece)
        at = np.repeat(np.arange(len(piece)), [len(w) for w in piece])
        columns = np.union1d(flat, zeros)
        hot = np.zeros((len(piece), len(columns)), np.float32)
        hot[:, np.searchsorted(columns, zeros)] = 1
        hot[at, np.searchsorted(columns, [zero_of[g] for g in level[0][flat].tolist()])] = 0
        hot[at, np.searchsorted(columns, flat)] = 1
        side = level[0][columns] // BLOCK_SOURCES
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        product = (hot[:, left].T @ hot[:, right]).astype(np.int64)
        yield product, [a[columns[left]] for a in level], [a[columns[right]] for a in level]


def _starts(names: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, names[1:] != names[:-1]])


def pair_values(counts: _Counts) -> DataFrame:
    """(lang, no, no2, value) for pairs of sources with no < no2: prices times joint tables, summed."""

    def price(key: tuple, cell: pa.Table) -> pa.Table:
        lang, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
        out = {"no": [], "no2": [], "value": [], "words": []}
        for product, (g, _, p), (h, _, q) in joint_tables_of_cell(cell, i, j):
            by = lambda m: np.add.reduceat(np.add.reduceat(m, _starts(g), axis=0), _starts(h), axis=1)
            value, words = by(product * np.abs(p[:, None] - q[None, :])), by(product)
            left, right = g[_starts(g)], h[_starts(h)]
            pair = left[:, None] < right[None, :]
            out["no"].append(np.broadcast_to(left[:, None], pair.shape)[pair])
            out["no2"].append(np.broadcast_to(right[None, :], pair.shape)[pair])
            out["value"].append(value[pair])
            out["words"].append(words[pair])
        flat = {c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in out.items()}
        return pa.table({"lang": pa.array([lang] * len(flat["no"]), pa.string())} | {c: pa.array(v.astype(np.int64)) for c, v in flat.items()})

    cells = _cells(counts).groupBy("lang", "bits", "part", "i", "j")
    found = cells.applyInArrow(price, "lang string, no long, no2 long, value long, words long")
    return found.groupBy("lang", "no", "no2").agg(F.sum("value").alias("value"), F.sum("words").alias("words"))


def joint_tables(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The joint tables themselves: (lang, source, other, count, other_count, terms), source < other.

    Terms that neither source has are in no row; with them a table adds up to the kept
    terms of the language. Null lang, source and text count as empty.
    """
    counts = _Counts(docs, min_docs)

    def tables(key: tuple, cell: pa.Table) -> pa.Table:
        lang, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
        out = [np.empty((5, 0), np.int64)]
        for product, (g, a, _), (h, b, _) in joint_tables_of_cell(cell, i, j):
            x, y = np.nonzero(product)
            wanted = (g[x] < h[y]) & ((a[x] > 0) | (b[y] > 0))
            x, y = x[wanted], y[wanted]
            out.append(np.stack([g[x], h[y], a[x], b[y], product[x, y]]))
        flat = np.concatenate(out, axis=1)
        names = ["no", "no2", "count", "other_count", "terms"]
        return pa.table({"lang": pa.array([lang] * flat.shape[1], pa.string())} | dict(zip(names, map(pa.array, flat))))

    cells = _cells(counts).groupBy("lang", "bits", "part", "i", "j")
    found = cells.applyInArrow(tables, "lang string, no long, no2 long, count long, other_count long, terms long")
    found = found.groupBy("lang", "no", "no2", "count", "other_count").agg(F.sum("terms").alias("terms"))
    name = lambda no, source: small(counts.groups.select("lang", F.col("no").alias(no), F.col("source").alias(source)), counts.size)
    named = found.join(name("no", "source"), ["lang", "no"]).join(name("no2", "other"), ["lang", "no2"])
    return named.select("lang", "source", "other", "count", "other_count", "terms")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): distance to each other source, and the telling terms.

    A language keeps the terms that at least ``min_docs`` of its documents hold. A term's
    share in a group is p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N being the
    group's occurrences of kept terms and V the number of kept terms. Part ``pair`` adds
    abs(p - q) over all kept terms, q of the other source, with all ranks; 0 without kept
    terms. Part ``term`` lists the ``top`` terms that the group has and whose p exceeds the
    language's q. Higher values first, ties by item in UTF-8 order.

    Null lang, source and text count as empty; documents without terms still make their
    group occur; repeated rows and ids count as documents of their own; extra columns are
    ignored; no documents give no rows. A language with one source has no pairs.
    """
    counts = _Counts(docs, min_docs)
    ranked = lambda: Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")

    telling = counts.priced().filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    telling = telling.withColumn("rank", F.row_number().over(ranked())).filter(F.col("rank") <= top)

    found = stored(pair_values(counts), "divergence-pairs")
    zero = _price(F.lit(0).cast("long"), "total", "kept")
    side = counts.groups.select("lang", "source", "no", "kept", zero.alias("zero"))
    other = counts.groups.select("lang", F.col("source").alias("item"), F.col("no").alias("no2"), zero.alias("zero2"))
    # As many rows as the result has: each source of a language with each other one.
    pairs = side.join(other, "lang").filter("no <> no2")
    lesser = found.withColumnsRenamed({"no": "lo", "no2": "hi", "lang": "_lang"})
    on = (F.col("lang") == F.col("_lang")) & (F.least("no", "no2") == F.col("lo")) & (F.greatest("no", "no2") == F.col("hi"))
    # Words that no source of the two blocks holds.
    rest = (F.col("kept") - F.coalesce("words", F.lit(0))) * F.abs(F.col("zero") - F.col("zero2"))
    value = F.coalesce("value", F.lit(0).cast("long")) + F.coalesce(rest, F.lit(0).cast("long"))
    pairs = pairs.join(lesser, on, "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(ranked()))
    return pairs.unionByName(telling)


def op11_level_product_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(t.total, 0)::HUGEINT AS total, coalesce(l.v, 0)::HUGEINT AS v, coalesce(l.total, 0)::HUGEINT AS all_n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source) LEFT JOIN l USING (lang)),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (g.all_n + 5 * g.v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM f x JOIN f y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 50
"""
