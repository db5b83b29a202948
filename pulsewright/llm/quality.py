"""Quality rules with risk-controlled thresholds.

Each rule is a score that grows as a text gets worse. Its cutoff is chosen per
stratum (language) on labelled documents: of the documents labelled good, the true
share a cutoff rejects must be at most ``risk`` per rule, shown by an exact binomial
test. The tests go from the most lenient cutoff to stricter ones and stop at the
first that fails, so they need no correction among themselves; strata and rules are
corrected by Bonferroni. With probability ``1 - error`` all chosen cutoffs keep their
promise at once, and all rules together reject at most ``risk`` of the good documents
of any stratum. A stratum with too few labels gets no cutoff and rejects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.llm.common import over_arrow, stored, table

BLANKS = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RISK, ERROR, BINS = 0.05, 0.05, 100
MAX_STRATA = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pair = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:  # keeps the number of a window inside 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(known) + ids[2:]
    _, inverse, times = np.unique(window, return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= again
    return int(hit.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode().split()
    seen: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            again += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        again,
        repeated_words(words),
        lines,
    )


def count_features(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema]

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = np.asarray([text_counts(t.as_py()) for t in batch.column("_text")], np.int64).reshape(-1, len(COUNTS))
        yield {c: batch.column(c) for c in keep} | {n: rows[:, i] for i, n in enumerate(COUNTS)}

    rows = docs.select(*keep, F.col("text").alias("_text"))
    return over_arrow(rows, count, ", ".join([*kept, *[f"{n} long" for n in COUNTS]]))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rule_scores() -> dict[str, Column]:
    """Scores from 0 to 1, larger is worse."""
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def allowed_rejections(n: int, risk: float, error: float) -> int:
    """Most rejections among n good documents that still prove a share of at most ``risk``.

    The largest k with P(Binomial(n, risk) <= k) <= error; -1 if even none is not enough.
    """
    total, k = 0.0, -1
    while k + 1 < n:
        i = k + 1
        log = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk)
        total += math.exp(log)
        if total > error:
            break
        k = i
    return k


def choose_cutoffs(
    counts: dict[tuple[str | None, str], np.ndarray], risk: float = RISK, error: float = ERROR
) -> dict[tuple[str | None, str], float]:
    """Cutoff per (stratum, rule) from histograms of good documents' scores.

    Bin b holds scores in (b - 1, b] / BINS, bin 0 holds 0. A score above the cutoff
    is rejected.
    """
    rules = len({r for _, r in counts}) or 1
    out = {}
    for key, bins in counts.items():
        most = allowed_rejections(int(bins.sum()), risk / rules, error / max(1, len(counts)))
        above = np.concatenate([np.cumsum(bins[::-1])[::-1][1:], [0]])  # good ones above cutoff b / BINS
        if most >= 0:
            failed = np.flatnonzero(above > most)
            out[key] = (int(failed[-1]) + 1 if len(failed) else 0) / BINS
    return out


def learn_cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[str | None, str], float]:
    """Cutoffs from all rows of good documents (``stratum`` and the counts)."""
    scores = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), s.alias("score")) for n, s in rule_scores().items()]))
    binned = good.select("stratum", scores.alias("s")).select(
        "stratum", "s.rule", F.least(F.ceil(F.col("s.score") * BINS), F.lit(BINS)).cast("int").alias("bin")
    )
    table_ = binned.groupBy("stratum", "rule", "bin").agg(F.count(F.lit(1)).alias("n"))
    most = MAX_STRATA * (BINS + 1) * len(rule_scores())
    counts: dict[tuple[str | None, str], np.ndarray] = {}
    for r in table_.limit(most + 1).collect():
        counts.setdefault((r["stratum"], r["rule"]), np.zeros(BINS + 1, np.int64))[r["bin"]] += r["n"]
    if len(counts) > MAX_STRATA * len(rule_scores()):
        raise ValueError(f"more than {MAX_STRATA} strata")
    return choose_cutoffs(counts, risk, error)


def assess(
    docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, stratum_col: str = "lang", id_col: str = "doc_id"
) -> DataFrame:
    """Counts, base_failed, kept and the failed rules of every document.

    A null text has no words and fails the base rule. A null stratum is a stratum of
    its own. A document counts as good if all its labels say quality 1; labels of
    unknown documents, null ids and null labels are ignored. Repeated rows are judged
    one by one; without labels only the base rule rejects. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), "text")
    features = stored(count_features(rows, ("doc_id", "stratum")), "quality-counts")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    cutoffs = learn_cutoffs(features.filter(~base_failed()).join(good, "doc_id", "left_semi"), risk, error)
    names = list(rule_scores())
    strata = sorted({s for s, _ in cutoffs}, key=lambda s: (s is None, s or ""))
    limits = spark.createDataFrame(
        [(s, *[cutoffs.get((s, n)) for n in names]) for s in strata], ", ".join(["s string", *[f"`cut_{n}` double" for n in names]])
    )
    joined = features.join(F.broadcast(limits), F.col("stratum").eqNullSafe(F.col("s")), "left")  # one row per stratum, checked
    failed = [F.when(score > F.col(f"cut_{n}"), F.lit(n)) for n, score in rule_scores().items()]
    return joined.select(
        "doc_id",
        *COUNTS[:5],
        base_failed().alias("base_failed"),
        F.array_compact(F.array(*failed)).alias("failed_rules"),
        F.col("stratum"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op9_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept")
