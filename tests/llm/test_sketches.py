import random
from math import comb

import pytest

from pulsewright.llm import sketches as s
from test_jaccard import brute, cases, family
from texts import vocabulary, words


def expected(docs, k, percent):
    return [(a, n, c, a == c) for a, n, c in brute(docs, k, percent)]


def same(got, want):
    key = lambda rows: sorted((str(a), n, str(c), kept) for a, n, c, kept in rows)
    return key(got) == key(want)


@pytest.mark.parametrize(("shingle", "percent", "k"), [(4, 80, 64), (5, 80, 32)])
def test_components_against_brute_force(docs_of, rows_of, shingle, percent, k):
    docs = cases()
    got = rows_of(s.sketch_components(docs_of(docs).repartition(5), shingle, percent, k))
    assert same(got, expected(docs, shingle, percent))


def passages():
    """Long documents, many of which hold one passage; some differ by little else, some by much."""
    pool = vocabulary(3000)
    passage = words(150, 7, pool)
    texts = []
    for i in range(120):
        r = random.Random(i)
        own = words(r.choice([3, 8, 14, 20, 26, 40, 150]), 1000 + i, pool)
        at = r.randint(0, len(own))
        texts.append(own[:at] + passage + own[at:])
    return [(i, " ".join(w)) for i, w in enumerate(texts)] + [(500 + i, t) for i, t in enumerate(family(5, 400, 60, 25, pool))]


def test_common_passages_and_loose_families(docs_of, rows_of):
    docs = passages()
    assert same(rows_of(s.sketch_components(docs_of(docs).repartition(4), 4, 80)), expected(docs, 4, 80))


def test_open_pairs_in_the_last_round(docs_of, rows_of, monkeypatch):
    monkeypatch.setattr(s, "ROUNDS", 1)
    docs = passages()
    assert same(rows_of(s.sketch_components(docs_of(docs), 4, 80)), expected(docs, 4, 80))


def test_least_shared():
    assert [s.least_shared(n, 80, 64) for n in (1, 10, 51)] == [1, 8, 41]
    # Just above the sketch's size, then far above: never more than the quantile of draws with replacement allows.
    assert s.least_shared(60, 80, 64) <= 48
    low = s.least_shared(10**6, 80, 64)
    tail = lambda m: sum(comb(64, x) * 0.8**x * 0.2 ** (64 - x) for x in range(m))
    assert tail(low) <= s.RISK < tail(low + 1)
    assert all(s.least_shared(n, 80, 64) >= low for n in range(200, 3000, 97))


def test_long_text_and_empty(docs_of, rows_of):
    long = " ".join(words(200_000, 3))
    docs = [(2, long), (1, long.upper()), (3, long + " tail"), (4, None), (5, "")]
    got = rows_of(s.sketch_components(docs_of(docs)))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True)]
    assert s.sketch_components(docs_of([])).count() == 0
