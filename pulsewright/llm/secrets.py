"""Secret scans: fixed formats, and character Markov models for the rest.

Two first-order Markov models over characters are trained from labelled samples, one of
random strings and one of ordinary identifiers. A long token counts as a secret if the
mean log-likelihood ratio of its character pairs is positive and above the cutoff that
all but a set share of the random strings pass. The cutoff comes from the random side,
as the ordinary side of a corpus may hold secrets nobody has labelled. Everything is
Column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import some_text, stored, table
from pulsewright.llm.spans import apart_from, find_all, joined, kinds

# The kinds in their order, with the shortest accepted match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 12
# A run that is too short has no longer match inside, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"

TOKEN = r"[A-Za-z0-9+/_=-]{16,}+"
LOW, WIDE = 43, 80  # '+' .. 'z'
# Long tokens that count as ordinary for training: words in one case or with a capital.
ORDINARY = "^(?:[A-Za-z]?[a-z]+(?:[_-][A-Za-z]?[a-z]++)*+|[A-Z]+(?:[_-][A-Z]++)*+)$"
LEAN = 20
SAMPLE_TOKENS = 200_000
MISS_RATE = 0.02


def _pair_index(value: Column) -> Column:
    """Index of each pair of neighbouring characters of a token."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.ascii(c) - LOW)
    return F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: a * WIDE + b)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character pair from all rows (value, random).

    Both models give a character after another one; seldom seen pairs lean on how
    frequent the character is by itself. Without samples of both kinds every ratio is
    zero. The table has a fixed size.
    """
    pairs = samples.select("random", F.explode(_pair_index(F.col("value"))).alias("pair"))
    counts = pairs.filter(F.col("pair").between(0, WIDE * WIDE - 1)).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    times: dict[bool, list[int]] = {True: [0] * (WIDE * WIDE), False: [0] * (WIDE * WIDE)}
    seen = set()
    for r in counts.collect():  # at most two numbers per pair
        times[r["random"]][r["pair"]] = r["n"]
        seen.add(r["random"])
    if len(seen) < 2:
        return [0.0] * (WIDE * WIDE)

    def logs(n: list[int]) -> list[float]:
        alone = [sum(n[b::WIDE]) + 1 for b in range(WIDE)]
        after = [sum(n[a * WIDE : (a + 1) * WIDE]) for a in range(WIDE)]
        whole = sum(alone)
        return [
            math.log((n[i] + LEAN * alone[i % WIDE] / whole) / (after[i // WIDE] + LEAN)) for i in range(WIDE * WIDE)
        ]

    return [a - b for a, b in zip(logs(times[True]), logs(times[False]), strict=True)]


def ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of a token."""
    # As text the table is one literal, folded to an array once.
    known = F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")
    pairs = _pair_index(value)
    total = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.coalesce(F.get(known, p), F.lit(0.0)))
    return total / F.greatest(F.length(value) - 1, F.lit(1))


def base_spans(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """``keep``, the sorted spans of fixed formats, and long tokens apart from them."""
    rows = docs.select(*keep, some_text(text_col).alias("_text"))
    found = find_all(rows, "_text", {"_assign": ASSIGN, "_access": ACCESS, "_hex": HEX, "_token": TOKEN})
    long_enough = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= ASSIGN_CHARS
    found = found.withColumn("_assign", F.filter("_assign", long_enough))
    based = found.select(*keep, kinds({"assign": "_assign", "access": "_access", "hex": "_hex"}).alias("base"), "_token")
    return based.select(*keep, "base", apart_from(F.col("_token"), F.col("base")).alias("tokens"))


def _samples(found: DataFrame, limit: int) -> DataFrame:
    """Labelled tokens: values of fixed formats are random, long words apart from them ordinary.

    About ``limit`` of each kind, picked by hash when there are more.
    """
    values = found.select(
        F.explode(
            F.concat(
                F.transform(
                    "base",
                    lambda s: F.struct(
                        F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 1)).otherwise(s["value"]).alias("value"),
                        F.lit(True).alias("random"),
                    ),
                ),
                F.transform("tokens", lambda s: F.struct(s["value"].alias("value"), F.lit(False).alias("random"))),
            )
        ).alias("s")
    ).select("s.value", "s.random")
    values = values.filter(F.col("random") | F.col("value").rlike(ORDINARY))
    n = {r["random"]: r["n"] for r in values.groupBy("random").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = lambda k: min(1.0, limit / max(1, n.get(k, 0)))
    part = F.pmod(F.xxhash64("value"), F.lit(1_000_003)) / 1_000_003
    return values.filter(part < F.when(F.col("random"), share(True)).otherwise(share(False)))


def scan(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    samples: DataFrame | None = None,
    sample_tokens: int = SAMPLE_TOKENS,
    miss_rate: float = MISS_RATE,
    text_col: str = "text",
) -> DataFrame:
    """``keep``, ``base`` and ``spans``: arrays of (start, rank, end, kind, value), sorted.

    ``samples`` (value, random) trains the models; by default it is taken from the
    corpus. Found tokens have the kind ``markov`` and never overlap a base span; base
    spans always stay. A null text is empty; repeated rows are scanned one by one;
    extra columns are ignored.
    """
    found = stored(base_spans(docs, keep, text_col), "secret-spans")
    labelled = stored(_samples(found, sample_tokens) if samples is None else samples, "secret-samples")
    # Half of the sample trains; the other half, which the models have not seen, sets the cutoff.
    fits = F.pmod(F.xxhash64("value", F.lit("half")), F.lit(2)) == 0
    model = train(labelled.filter(fits))
    known = labelled.filter(F.col("random") & ~fits).select(ratio(F.col("value"), model).alias("r"))
    cut = known.agg(F.percentile_approx("r", miss_rate, 10_000).alias("c")).first()["c"]
    cutoff = max(0.0, cut) if cut is not None else math.inf
    added = F.transform(
        F.filter("tokens", lambda s: ratio(s["value"], model) > cutoff),
        lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("rank"), s["end"].alias("end"), F.lit("markov").alias("kind"), s["value"].alias("value")),
    )
    return found.select(*keep, "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op5_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
