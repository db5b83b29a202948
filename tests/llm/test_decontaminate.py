import random
import re

import numpy as np
import pytest

from pulsewright.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item_id, body in items:
        own = WORD.findall(lower(body))
        k = min(window, len(own))
        for p in range(len(own) - k + 1 if k else 0):
            for q in range(len(words) - k + 1):
                if words[q : q + k] == own[p : p + k]:
                    hit.update(range(q, q + k))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def cases():
    r = random.Random(3)
    pool = ["alpha", "Beta", "gamma", "dé", "x1", "yy"]
    text = lambda n: " ".join(r.choice(pool) + r.choice(["", ",", "!\n"]) for _ in range(n))
    items = [(i, text(r.choice([3, 9, 10, 11, 14]))) for i in range(8)]
    items += [(1, "Short one"), (None, "null id item of some words here to be found in text"), (20, None), (21, " .,! "), (22, "word")]
    docs = [(i, text(r.choice([0, 5, 30, 200]))) for i in range(25)]
    docs += [(100, None), (101, ""), (None, "a SHORT one, here"), (102, "a b null id item of some words here to be found in text"), (102, "word")]
    docs += [(103, items[3][1]), (104, "alpha " * 500), (103, items[3][1]), (105, "pre " + items[0][1].upper() + " post é")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_against_brute_force(spark, docs_of, block_bytes):
    docs, items = cases()
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, n_words string")
    found = d.find_leaks(docs_of(docs), bench, keep=("doc_id", "text"), block_bytes=block_bytes).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, ids = brute(r["text"], items)
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) == (n, hit, ids)
        assert (r["cleaned"] is None) == (hit == 0)
        if hit:
            assert len(WORD.findall(lower(r["cleaned"]))) == n - hit


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.find_leaks(docs_of([]), bench).count() == 0
    row = d.find_leaks(docs_of([(1, "a b c")]), bench).first()
    assert (row["n_words"], row["spans"], row["items"]) == (3, [], [])


def test_index_search_and_locate():
    r = np.random.default_rng(5)
    body = np.append(r.integers(0, 4, 4000), 0)
    text = np.concatenate([[0], body])
    index = d.FMIndex(text)
    phrases = d.Phrases([("a", "q w e"), ("b", "w w"), ("c", "e")])
    which, low, high = index.search(phrases)
    places = {p: set() for p in range(len(phrases.width))}
    for p, lo, hi in zip(which, low, high, strict=True):
        places[p] = set(index.locate(np.arange(lo, hi)).tolist())
    for p, width in enumerate(phrases.width):
        want = phrases.code[p, :width]
        assert places[p] == {i for i in range(len(text) - width) if (text[i : i + width] == want).all()}


def test_removal_keeps_the_rest():
    assert d.without_spans("One, two three. Four!", [(1, 3)]) == "One, . Four!"


def test_phrases_are_the_distinct_windows_and_their_items():
    r = random.Random(3)
    items = [(r.choice(["a", "b", "c", None]), " ".join(r.choice("xyz") for _ in range(r.randint(0, 7)))) for _ in range(60)] + [("d", None)]
    want = {}
    for item_id, text in items:
        own = (text or "").encode().split()
        width = min(3, len(own))
        for at in range(len(own) - width + 1 if width else 0):
            want.setdefault(tuple(own[at : at + width]), set()).update({item_id} - {None})
    made = d.Phrases(items, 3)
    word = {n: w for w, n in made.symbol.items()}
    got = {tuple(word[c] for c in code[:n]): made.items_of(i) for i, (code, n) in enumerate(zip(made.code, made.width, strict=True))}
    assert got == {k: sorted(v) for k, v in want.items()} and len(got) == len(made.width)


def test_blocks_hold_every_item_once_within_their_bound(spark):
    bench = [(str(i), "w" * (i % 90)) for i in range(400)] + [("big", "x" * 3000), (None, "no id"), ("null", None)]
    frame = spark.createDataFrame(bench + bench[:50], "item_id string, text string")
    blocks = list(d._blocks(frame, 2000))
    assert len(blocks) > 10
    assert sorted(map(str, (i for b in blocks for i in b))) == sorted(map(str, bench))
    for b in blocks:
        sizes = [len(t or "") + 64 for _, t in b]
        assert sum(sizes) - max(sizes) < 2000
