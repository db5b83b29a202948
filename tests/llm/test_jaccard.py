import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsewright.llm import jaccard as j
from texts import vocabulary, words


def sets_of(docs, k):
    out = []
    for _, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in __import__("re").findall("[^\x20\x09-\x0d]+", low)]
        n = min(k, len(w))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    return out


def brute(docs, k, percent):
    sets = sets_of(docs, k)
    comp = list(range(len(docs)))
    live = [i for i, d in enumerate(docs) if d[0] is not None and sets[i]]
    changed = True
    links = [(a, b) for a in live for b in live if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    least = {}
    for i in live:
        least[comp[i]] = min(least.get(comp[i], docs[i][0]), docs[i][0])
    return [(d[0], len(sets[i]), least[comp[i]] if i in live else d[0]) for i, d in enumerate(docs)]


def family(seed, n, copies, edits, pool):
    r = random.Random(seed)
    base = words(n, seed, pool)
    out = [base]
    for _ in range(copies):
        w = list(r.choice(out))
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(pool)
        out.append(w)
    return [" ".join(w) for w in out]


def cases():
    pool = vocabulary(300)
    texts = [" ".join(words(random.Random(i).randint(1, 90), i, pool)) for i in range(60)]
    texts += family(1, 80, 40, 2, pool) + family(2, 60, 30, 4, pool) + family(3, 12, 25, 1, pool)
    texts += ["the same passage of some common words " * 2 + " ".join(words(20, 500 + i, pool)) for i in range(20)]
    texts += ["one", "ONE", "one two three", "One  Two\nthree", "a b c d", "a b c d a b c d", "é É"]
    docs = [(i, t) for i, t in enumerate(texts)]
    random.Random(0).shuffle(docs)
    return docs + [(900, None), (901, ""), (902, " \n"), (None, texts[0]), (None, None), (903, texts[61]), (903, texts[61])]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_components_against_brute_force(docs_of, rows_of, k, percent):
    docs = cases()
    got = rows_of(j.jaccard_components(docs_of(docs).repartition(5), k, percent))
    key = lambda rows: sorted((str(a), n, str(c)) for a, n, c in rows)
    assert key(got) == key(brute(docs, k, percent))


def test_keep_one_and_empty(docs_of):
    kept = j.keep_one(docs_of([(3, "a b c d e f"), (1, "A b c d e f"), (2, "x y"), (4, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert j.jaccard_components(docs_of([])).count() == 0


def test_bitmap(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    made = j.bitmap_of(spark.createDataFrame([(int(v),) for v in values], "v long"), "v", bits=16)
    assert j.in_bitmap(made, values).all()
    assert sum(bin(int(w)).count("1") for w in made) == len({int(v) & 0xFFFF for v in values})


def test_few_words_are_held_together():
    known, held = j.WordHashes(), []

    def hashes(words):
        held.append(len(words))
        return known(words)

    texts = [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(600)]
    sets = list(j.shingle_sets(texts, 4, hashes))
    assert [len(s) for s in sets] == [997] * 600 and max(held) <= 101_000 and sum(held) == 600_000


def below_threshold(pool):
    """Texts of one long passage with words of their own in the middle: all share it, none links (4 words, 85 percent)."""
    passage = words(120, 77, pool)
    return [" ".join([*passage[:60], *(f"own{i}x{k}" for k in range(5)), *passage[60:]]) for i in range(40)]


def test_open_pairs_are_few_in_a_group_below_the_threshold(spark, docs_of, rows_of, monkeypatch):
    """Only pairs that pass the partition sizes leave the join; all pairs of the group would be 780."""
    texts = below_threshold(vocabulary(300))
    docs = list(enumerate([*texts, texts[0].replace("own0x0", "other")]))
    made, pairs = [], j._open_meetings
    monkeypatch.setattr(j, "_open_meetings", lambda *a: made.append(pairs(*a).count()) or pairs(*a))
    got = rows_of(j.jaccard_components(docs_of(docs), 4, 85))
    assert sorted(got) == sorted(brute(docs, 4, 85))
    assert made and made[0] < len(docs) * (len(docs) - 1) // 2


def test_rows_of_a_shingle_meet_once(spark):
    """Copies of a class from several tasks fold, shingles of one class go, and leaders are found in the same shuffle."""
    rows = [(1, 10, [7, 8]), (1, 10, [7, 8]), (2, 10, [7, 9]), (3, 100, [7])]
    classes = spark.createDataFrame([(*r, [0]) for r in rows], "sig long, n long, prefix array<long>, bins array<int>").repartition(3)
    found = j._postings(classes, 85)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r["token"], r["sig"], r["pos"], r["classes"]): set(r["met"]) for r in found.collect()}
    # The third is too long to match the others.
    assert set(got) == {(7, 1, 0, 3), (7, 2, 0, 3), (7, 3, 0, 3)}
    assert got[(7, 3, 0, 3)] == set() and got[(7, 1, 0, 3)] <= {2} and got[(7, 2, 0, 3)] <= {1}


def test_only_sets_in_a_pair_move(spark, docs_of):
    """Pairs far apart by their finer partition sizes are gone before whole sets meet."""
    pool = vocabulary(300)
    near, far = family(5, 90, 1, 1, pool), [" ".join(words(90, 900 + i, pool)) for i in range(2)]
    docs = docs_of(list(enumerate([*near, *far]))).select("doc_id", "text")
    signed = j._signatures(docs, 4).filter("bucket is null").select("doc_id", "n", "sig")
    n, sig = ({r["doc_id"]: r[c] for r in signed.collect()} for c in ("n", "sig"))
    sets = j._Sets(docs, signed.select("sig", F.col("doc_id").alias("rep")), 4)
    pairs = spark.createDataFrame([(sig[a], sig[b], n[a], n[b]) for a, b in ((0, 1), (2, 3))], "a long, b long, n_a long, n_b long")
    moved, met = [], sets._met
    sets._met = lambda left, col: moved.append((col, left.count())) or met(left, col)
    assert [tuple(r) for r in sets.verified(pairs, 80).collect()] == [(sig[0], sig[1])]
    assert moved == [("fine", 2), ("grams", 1)]
