import random
import re

import numpy as np
import pytest

from pulsewright.llm import repeats as p
from texts import vocabulary, words


def brute(docs, window):
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in docs]
    least = {}
    for (i, _), w in zip(docs, split, strict=True):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(docs, split, strict=True):
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if least[tuple(w[k : k + window])] < i:
                    gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def cases(window):
    r = random.Random(window)
    pool = vocabulary(60) + ["É", "a"]
    passage = words(window + 7, 1, pool)
    texts = []
    for i in range(50):
        w = words(r.randint(0, 3 * window), i, pool)
        if i % 4 == 0:
            at = r.randrange(len(w) + 1)
            w[at:at] = passage[r.randint(0, 3) : window + r.randint(0, 7)]
        texts.append(" ".join(w))
    texts += ["a " * (3 * window), "a " * (2 * window) + "b", "x " + "a b " * (2 * window), "y z " + "a b " * window]
    texts += [texts[4], texts[4], texts[8] + " tail", "Head " + texts[8]]
    docs = [(r.randint(0, 40) * 3 + i % 3, t) for i, t in enumerate(texts)]
    return docs + [(500, None), (501, ""), (None, texts[4]), (docs[0][0], texts[5]), (docs[4][0], texts[4]), (docs[4][0], texts[4])]


@pytest.mark.parametrize("window", [5, 12, 50])
def test_against_brute_force(docs_of, window):
    docs = cases(window)
    rows = p.remove_repeats(docs_of(docs).repartition(4), window).collect()
    key = lambda rows: sorted((str(a), b, c, d) for a, b, c, d in rows)
    assert key(tuple(r) for r in rows) == key(brute(docs, window))


def test_empty_table(docs_of):
    assert p.remove_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("window", [8, 50])
def test_equal_windows_have_equal_anchors(window):
    r = np.random.default_rng(window)
    names = r.integers(0, 2**63, 30).astype(np.uint64)
    block = names[r.integers(0, 3 if window == 8 else 30, 3 * window)]
    parts, gap = [], []
    for k in range(6):
        own = np.concatenate([names[r.integers(0, 30, r.integers(0, 20))], block, names[r.integers(0, 30, r.integers(0, 20))]])
        parts += [np.zeros(1, np.uint64), own]
        gap += [np.ones(1, bool), np.zeros(len(own), bool)]
    w, g = np.concatenate([*parts, np.zeros(1, np.uint64)]), np.concatenate([*gap, np.ones(1, bool)])
    start, anchor = p.window_anchors(w, g, window)
    seen = {}
    for s, a in zip(start, anchor, strict=True):
        assert seen.setdefault(tuple(w[s : s + window]), a) == a
    whole = p.WindowHashes()(w, start, window)
    by = {}
    for s, h in zip(start, whole, strict=True):
        assert by.setdefault(tuple(w[s : s + window]), h) == h
    assert len(set(by.values())) == len(by)


def test_anchors_are_sparse():
    r = np.random.default_rng(1)
    w, g = r.integers(0, 2**63, 20_000).astype(np.uint64), np.zeros(20_000, bool)
    w[[0, -1]], g[[0, -1]] = 0, True
    _, anchor = p.window_anchors(w, g, 50)
    assert (anchor[1:] != anchor[:-1]).sum() < 20_000 / 6
