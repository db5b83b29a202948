import random
import re
from collections import Counter

import numpy as np

from pulsewright.llm import quality as q


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(hit)


def cases():
    r = random.Random(8)
    pool = ["a", "bb", "ç d", "#x", "*", "\x1fz", "end.\n", "\n", "\n\n", "e|f"]
    texts = [" ".join(r.choice(pool[: r.randint(1, 10)]) for _ in range(r.choice([0, 1, 3, 4, 60, 300]))) for _ in range(60)]
    return [*texts, None, "", " ", "\n\n", "a a a a", "x\ny\nx\n x", "w " * 5000]


def test_counts_against_brute_force():
    for text in cases():
        assert q.text_counts(text)[:5] == brute(text), repr(text)


def test_allowed_rejections_is_the_exact_bound():
    from math import comb

    for n in (1, 10, 59, 300):
        for risk, error in ((0.05, 0.05), (0.02, 0.01)):
            k = q.allowed_rejections(n, risk, error)
            tail = lambda m: sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(m + 1))
            assert k < 0 or tail(k) <= error
            assert k + 1 >= n or tail(k + 1) > error


def test_cutoffs_keep_their_promise_and_stop_at_the_first_failure():
    bins = np.zeros(q.BINS + 1, np.int64)
    bins[0], bins[10], bins[60] = 5000, 60, 4
    cut = q.choose_cutoffs({("en", "symbols"): bins}, risk=0.01, error=0.05)[("en", "symbols")]
    assert cut == 0.1
    few = np.zeros(q.BINS + 1, np.int64)
    few[0] = 20
    assert q.choose_cutoffs({("en", "symbols"): few}) == {}


def test_verdicts(spark, docs_of):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    clean = [(i, " ".join(word() for _ in range(80)), "en") for i in range(600)]
    dirty = [(1000 + i, " ".join(word() + "###" for _ in range(80)), "en") for i in range(5)]
    odd = [(2000, None, None), (2001, "", "en"), (None, " ".join(word() for _ in range(80)), None), (2003, "too short", "en")]
    odd += [(3, clean[3][1], "en"), (2004, "one two three " * 40, "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)] + [(1000, 0, 0), (None, 1, 0), (5, 1, 1), (7777, 1, 0)], "doc_id long, quality int, toxic int")
    rows = q.assess(docs_of(clean + dirty + odd), labels).collect()
    assert len(rows) == 611
    for row in rows:
        i = row["doc_id"]
        if i is None or i < 1000:
            assert row["kept"] and not row["base_failed"]
        elif i < 2000:
            assert not row["kept"] and row["failed_rules"] == ["symbols"]
        else:
            assert row["base_failed"] and not row["kept"]
    none = q.assess(docs_of(clean[:3] + dirty), labels.limit(0)).collect()
    assert all(r["kept"] for r in none)
    assert q.assess(docs_of([]), labels).count() == 0
