"""Personal data: fixed formats, and boosted trees over candidate spans for the rest.

High-recall generators propose overlapping spans: the fixed formats before their
checks, and loose forms of the same things. Each candidate is described by a few small
whole numbers (format and words just before it). Boosted regression trees learn from
candidates whose label the checks give (a passed checksum, a valid address, a plausible
length) or, for loose forms, the words just before; a cutoff per generator is calibrated on candidates kept apart from learning.
Candidates of loose forms above their cutoff are redacted.

Equal descriptions are counted by Spark before learning, so the learner sees a table
bounded by the number of descriptions. The trees are applied as Column expressions.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import some_text, stored, table
from pulsewright.llm.spans import apart_from, digits, find_all, joined, kinds

# Fixed formats. Possessive loops keep Java from recursing on long runs; the start test
# lets a run be tried once, from its first character or from the end of the last match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_VALID = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

# Loose forms, proposed by further generators.
LOOSE = {
    "loose_email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\))\x20?[a-z0-9-]{1,63}+(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[a-z0-9-]{1,63}+){1,4}+",
    "loose_phone": r"(?<![0-9A-Za-z.+-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9-])",
    "loose_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
CONTEXT = r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|pay|ip|addr|ssn|social)[^0-9\n]{0,16}$"
# Words before numbers that only look alike.
COUNTER = r"(?i)(?:order|invoice|ref|part|item|serial|isbn|version|total|sum|batch|model|ticket|tracking)[^0-9\n]{0,16}$"
# Card candidates that are nothing but a loose phone or id: failing as a card says nothing of them.
ALSO_LOOSE = r"^(?:[0-9]{2,4}[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"
LOOK_BACK = 32

GENERATORS = ("email", "ip", "card", "phone", *LOOSE)
TREES, RATE, PRECISION, LEAST = 20, 0.3, 0.95, 20


class Split(NamedTuple):
    """Two-level tree: (feature, cut) at the root and per side, four leaf values."""

    root: tuple[int, int]
    sides: tuple[tuple[int, int], tuple[int, int]]
    leaves: tuple[float, float, float, float]


# Per candidate, in this order; all are small whole numbers.
FEATURES = ("generator", "length", "digits", "marks", "first_mark", "context", "letter_before", "counter")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    n = F.size(F.split(number, ""))
    values = F.transform(F.reverse(F.filter(F.split(number, ""), lambda c: c != "")), lambda c, i: (
        F.when(i % 2 == 0, c.cast("int")).otherwise(F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int")))
    ))
    return (n > 0) & (F.aggregate(values, F.lit(0), lambda s, x: s + x) % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    size = F.length(digits(value))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(IP_VALID)
    if kind == "card":
        return F.when(size.between(12, 19), luhn(digits(value))).otherwise(False)
    return size.between(9, 15)


def _described(spans: Column, text: Column, generator: int) -> Column:
    """Candidates with their description."""

    def one(s: Column) -> Column:
        from_ = F.greatest(s["start"] + 1 - LOOK_BACK, F.lit(1))
        before = F.substr(text, from_, F.least(s["start"], F.lit(LOOK_BACK)))
        size = F.length(digits(s["value"]))
        first = F.regexp_extract(s["value"], "[^0-9A-Za-z]", 0)
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            F.array(
                F.lit(generator),
                F.least(F.length(s["value"]), F.lit(40)),
                F.least(size, F.lit(20)),
                F.least(F.length(s["value"]) - F.length(F.regexp_replace(s["value"], "[^0-9A-Za-z]", "")), F.lit(8)),
                F.when(first == "", 0).when(first == " ", 1).when(first == "-", 2).when(first == ".", 3).when(first == "+", 4).otherwise(5),
                before.rlike(CONTEXT).cast("int"),
                before.rlike("[A-Za-z]$").cast("int"),
                (before.rlike(COUNTER) & ~before.rlike(CONTEXT)).cast("int"),
            ).alias("x"),
        )

    return F.transform(spans, one)


def propose(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """``keep``, sorted valid spans ``base``, ``checked`` (label, x) and ``loose`` candidates."""
    text = F.col("_text")
    rows = docs.select(*keep, some_text(text_col).alias("_text"))
    base = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    found = find_all(rows, "_text", {f"_{k}": p for k, p in (base | LOOSE).items()})
    valid = lambda k: F.filter(f"_{k}", lambda s: _valid(k, s["value"]))
    split = found.select(
        *keep,
        "_text",
        *[valid(k).alias(f"_ok_{k}") for k in base],
        *[f"_{k}" for k in (*base, *LOOSE)],
    )
    # Short numbers are no candidates for anything; they would swamp the learner.
    told = lambda k, s: ~s["value"].rlike(ALSO_LOOSE) if k == "card" else F.lit(True)
    serious = lambda k: F.filter(f"_{k}", lambda s: (F.length(digits(s["value"])) >= (0 if k == "email" else 7)) & told(k, s))
    labelled = lambda k: F.transform(
        _described(serious(k), text, GENERATORS.index(k)),
        lambda s: F.struct(_valid(k, s["value"]).cast("int").alias("label"), s["x"].alias("x")),
    )
    checked = [labelled(k) for k in base]
    loose = [_described(F.col(f"_{k}"), text, GENERATORS.index(k)) for k in LOOSE]
    all_base = kinds({k: f"_ok_{k}" for k in base})
    out = split.select(*keep, all_base.alias("base"), F.concat(*checked).alias("checked"), F.concat(*loose).alias("_loose"))
    apart = out.select(*keep, "base", "checked", apart_from(F.col("_loose"), F.col("base")).alias("loose"))
    # Words before a loose form label it; without any it is left to the trees.
    at = lambda s, name: F.get(s["x"], F.lit(FEATURES.index(name)))
    named = F.filter("loose", lambda s: (at(s, "context") == 1) | (at(s, "counter") == 1))
    by_words = F.transform(named, lambda s: F.struct(at(s, "context").alias("label"), s["x"].alias("x")))
    return apart.select(*keep, "base", F.concat("checked", by_words).alias("checked"), "loose")


def _best_cut(x: np.ndarray, g: np.ndarray, w: np.ndarray, rows: np.ndarray) -> tuple[tuple[int, int], float]:
    """The (feature, cut) that lowers the squared error of ``g`` most; rows with x <= cut go left."""
    best, gain = (1, 1 << 20), 0.0  # by default all go left
    for f in range(x.shape[1]):
        for cut in np.unique(x[rows, f])[:-1]:
            left = rows[x[rows, f] <= cut]
            right = rows[x[rows, f] > cut]
            score = sum((g[s] * w[s]).sum() ** 2 / w[s].sum() for s in (left, right)) - (g[rows] * w[rows]).sum() ** 2 / w[rows].sum()
            if score > gain + 1e-12:
                best, gain = (f, int(cut)), score
    return best, gain


def boost(x: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES, rate: float = RATE) -> tuple[float, list[Split]]:
    """Gradient boosting for the log loss over counted descriptions."""
    share = float(np.clip(np.average(label, weights=weight), 0.01, 0.99))
    base = float(np.log(share / (1 - share)))
    score, out = np.full(len(x), base), []
    every = np.arange(len(x))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g = label - p
        root, gain = _best_cut(x, g, weight, every)
        if gain <= 0:
            break
        halves = [every[x[:, root[0]] <= root[1]], every[x[:, root[0]] > root[1]]]
        sides, leaves = [], []
        for half in halves:
            cut, _ = _best_cut(x, g, weight, half)
            sides.append(cut)
            for leaf in (half[x[half, cut[0]] <= cut[1]], half[x[half, cut[0]] > cut[1]]):
                curve = (p[leaf] * (1 - p[leaf]) * weight[leaf]).sum() + 1.0
                value = float(rate * (g[leaf] * weight[leaf]).sum() / curve)
                score[leaf] += value
                leaves.append(round(value, 6))
        out.append(Split(root, (sides[0], sides[1]), tuple(leaves)))
    return base, out


def tree_score(x: Column, base: float, trees: list[Split]) -> Column:
    total = F.lit(base)
    for t in trees:
        at = lambda cut: F.get(x, F.lit(cut[0])) <= cut[1]
        total = total + F.when(
            at(t.root), F.when(at(t.sides[0]), t.leaves[0]).otherwise(t.leaves[1])
        ).otherwise(F.when(at(t.sides[1]), t.leaves[2]).otherwise(t.leaves[3]))
    return total


def _numpy_score(x: np.ndarray, base: float, trees: list[Split]) -> np.ndarray:
    total = np.full(len(x), base)
    for t in trees:
        low = lambda cut: x[:, cut[0]] <= cut[1]
        total += np.where(
            low(t.root), np.where(low(t.sides[0]), t.leaves[0], t.leaves[1]), np.where(low(t.sides[1]), t.leaves[2], t.leaves[3])
        )
    return total


def calibrate(score: np.ndarray, label: np.ndarray, weight: np.ndarray, precision: float = PRECISION, least: int = LEAST) -> float | None:
    """The lowest cutoff above which the share of true candidates is at least ``precision``; None if none is shown."""
    order = np.argsort(-score, kind="stable")
    true, all_ = np.cumsum((label * weight)[order]), np.cumsum(weight[order])
    last = np.append(score[order][1:] != score[order][:-1], True)  # ties stand or fall together
    good = np.flatnonzero(last & (true >= precision * all_) & (all_ >= least))
    return float(score[order][good[-1]]) if len(good) else None


# The checked kinds whose labels calibrate a loose generator.
CALIBRATED_BY = {"loose_email": ("email",), "loose_phone": ("phone",), "loose_id": ("card", "phone")}


def learn(found: DataFrame) -> tuple[float, list[Split], dict[str, float]]:
    """Trees and cutoffs from the checked candidates of all texts.

    Odd halves of the texts, told apart by hash, learn; even halves calibrate.
    """
    part = F.pmod(F.xxhash64("base", "checked"), F.lit(1_000_003))
    picked = found.select((part % 2).alias("half"), F.explode("checked").alias("c"))
    counted = picked.groupBy("half", "c.label", "c.x").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.collect()  # bounded by the number of descriptions
    if not rows:
        return 0.0, [], {}
    x = np.asarray([r["x"] for r in rows], np.int64)
    label, weight = np.asarray([r["label"] for r in rows], float), np.asarray([r["n"] for r in rows], float)
    half = np.asarray([r["half"] for r in rows])
    one, two = half == 1, half == 0
    if not one.any() or not two.any():
        return 0.0, [], {}
    base, trees = boost(x[one], label[one], weight[one])
    cutoffs = {}
    for kind, by in CALIBRATED_BY.items():
        # By its own labelled candidates if they are enough, else by those of the checked kinds.
        for names in ((kind,), by):
            own = two & np.isin(x[:, 0], [GENERATORS.index(k) for k in names])
            if own.any() and (cut := calibrate(_numpy_score(x[own], base, trees), label[own], weight[own])) is not None:
                cutoffs[kind] = cut
                break
    return base, trees, cutoffs


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep``, ``base`` and ``spans``: arrays of (start, rank, end, kind, value), sorted.

    Base spans always stay; found candidates have the kind ``model`` and overlap no
    base span. A null text is empty; repeated rows are searched one by one; extra
    columns are ignored. Without checked candidates to learn from nothing is added.
    """
    found = stored(propose(docs, keep, text_col), "pii-candidates")
    base, trees, cutoffs = learn(found)
    above = lambda s: F.coalesce(
        *[F.when(F.get(s["x"], F.lit(0)) == GENERATORS.index(k), tree_score(s["x"], base, trees) >= cut) for k, cut in cutoffs.items()],
        F.lit(False),
    )
    added = F.transform(
        F.filter("loose", above),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(4).alias("rank"), s["end"].alias("end"), F.lit("model").alias("kind"), s["value"].alias("value")
        ),
    )
    return found.select(*keep, "base", F.array_sort(F.array_distinct(F.concat("base", added))).alias("spans"))


def op6_boosted_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
