import random

import numpy as np

from pulsewright.llm import language as h

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "öt"], "cc": ["ла", "не", "про"]}


def text(lang, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def corpus():
    rows = [(i, text(lang, 5 + i % 40, i), lang) for i in range(90) for lang in [list(SYLLABLES)[i % 3]]]
    return rows + [(None, text("aa", 30, 7), "aa"), (200, None, "aa"), (201, "", "bb"), (202, "123 !?", "cc"), (203, text("bb", 9, 1), None)]


def brute_vector(body, dimensions, seed):
    letters = "".join(c if c.isalpha() else " " for c in body.lower()).split()
    padded = " " + " ".join(letters) + " "
    vector = lambda c: h.letter_vector(ord(c), dimensions, seed).astype(np.int64)
    total = np.zeros(dimensions, np.int64)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        total += np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
    return total


def test_bundle_against_brute_force():
    made = h.Bundler(64, 7)
    texts = ["Ab, cd! ab", "x", "жук 12 é", "a" * 50]
    total, letters = made.bundle(list(enumerate(texts)), len(texts))
    for row, body in enumerate(texts):
        assert (total[row] == brute_vector(body, 64, 7)).all()
    assert letters.tolist() == [6, 1, 4, 50]
    many = "".join(chr(0x4E00 + i) for i in range(400))  # too many letters for the dense table
    assert (made.bundle([(0, many)], 1)[0][0] == brute_vector(many, 64, 7)).all()


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(corpus()).withColumn("held_out", h.held_out())
    prototypes = h.learn_prototypes(docs.filter(~F.col("held_out")))
    assert list(prototypes) == ["aa", "bb", "cc"]
    rows = h.identify(docs, prototypes, keep=("doc_id", "lang", "held_out", "text")).collect()
    assert len(rows) == len(corpus())
    kept = [r for r in rows if r["held_out"] and r["doc_id"] < 200]
    assert len(kept) > 10 and all(r["lang_pred"] == r["lang"] for r in kept)
    for r in rows:
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    # lang, source and id are no inputs
    other = docs.withColumn("lang", F.lit("aa")).withColumn("doc_id", F.lit(1))
    again = sorted((r["text"] or "", r["lang_pred"], r["score"]) for r in h.identify(other, prototypes, keep=("text",)).collect())
    assert again == sorted((r["text"] or "", r["lang_pred"], r["score"]) for r in rows)


def test_nothing_learnt_and_empty(docs_of):
    rows = h.identify(docs_of([(1, "abc")]), {}, keep=("doc_id",)).collect()
    assert [tuple(r) for r in rows] == [(1, "und", 0.0)]
    assert h.learn_prototypes(docs_of([])) == {}


def test_very_long_text():
    made = h.Bundler(32, 7)
    body = "ab cd " * 500_000
    total, letters = made.bundle([(0, body)], 1)
    assert letters[0] == 2_000_000 and np.abs(total).max() > 0


def test_no_trigram_is_lost_where_a_long_text_is_cut(monkeypatch):
    r, bodies = random.Random(8), ["", " ", "!a", "ab", "ab!cd ,, e"]
    bodies += ["".join(r.choice("abö .,\n1ж") for _ in range(r.randint(1, 60))) for _ in range(40)]
    whole = h.Bundler(64, 7).bundle(list(enumerate(bodies)), len(bodies))
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(h, "PIECE", piece)
        total, letters = h.Bundler(64, 7).bundle(list(enumerate(bodies)), len(bodies))
        assert (total == whole[0]).all() and (letters == whole[1]).all()
    assert (whole[0][bodies.index("ab!cd ,, e")] == brute_vector("ab!cd ,, e", 64, 7)).all()


def test_a_text_beyond_one_piece_against_brute_force():
    body = "ab" * (h.PIECE // 2 - 1) + "x" + "cde" * 10  # a word lies across the cut
    counted = {}
    padded = f" {body} "
    for at in range(len(padded) - 2):
        counted[padded[at : at + 3]] = counted.get(padded[at : at + 3], 0) + 1
    vector = lambda c: h.letter_vector(ord(c), 32, 7).astype(np.int64)
    want = sum(n * np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for (a, b, c), n in counted.items())
    total, letters = h.Bundler(32, 7).bundle([(0, body)], 1)
    assert (total[0] == want).all() and letters[0] == len(body) > h.PIECE


def test_a_kept_text_travels_once(spark, capsys):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None)], "doc_id long, text string")
    judged = h.identify(docs, {"en": np.ones(1024)}, keep=("doc_id", "text"))
    judged.explain()
    assert "_text" not in capsys.readouterr().out
    assert judged.columns == ["doc_id", "text", "lang_pred", "score"] and judged.filter("text is null").count() == 1
