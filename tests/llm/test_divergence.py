import random
from collections import Counter

import pytest

from pulsewright.llm import divergence as d
from texts import vocabulary, words

CUT = [chr(c) for c in range(128) if not chr(c).isalpha()]


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in CUT:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute(docs, min_docs, top):
    groups, holds = {}, {}
    for _, text, lang, source in docs:
        found = terms(text)
        groups.setdefault((lang or "", source or ""), Counter()).update(found)
        holds.setdefault(lang or "", Counter()).update(set(found))
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t, n in holds[lang].items() if n >= min_docs]
        of = {s: c for (l, s), c in groups.items() if l == lang}
        whole = sum(of.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept))

        pair = [(o, sum(abs(share(mine, t) - share(c, t)) for t in kept)) for o, c in of.items() if o != source]
        term = [(t, share(mine, t) - share(whole, t)) for t in kept if mine[t] and share(mine, t) > share(whole, t)]
        for part, rows, limit in (("pair", pair, None), ("term", term, top)):
            rows = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:limit]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(rows)]
    return sorted(out)


def cases(sources=7):
    pool = vocabulary(60) + ["Über", "über", "東京", "Çà"]
    r = random.Random(4)
    docs = [(i, " ".join(words(r.randint(0, 60), i, pool)), r.choice(["en", "de"]), f"s{r.randrange(sources)}") for i in range(150)]
    docs += [(200 + i, "common common words here", "en", "s0") for i in range(80)]
    docs += [(900, None, "en", "empty"), (901, "1 2 3 -", "en", "digits"), (902, "", None, None), (903, "lone", "xx", "only")]
    docs += [(904, "rare text", "yy", "a"), (905, "other text", "yy", "b"), (None, "Common", "en", None), (906, "a\x00b\x7fc " * 9000, "en", "s1")]
    return docs + docs[:3]


@pytest.mark.parametrize(("min_docs", "top", "columns", "sources"), [(3, 50, 1024, 7), (30, 5, 8, 7), (2, 50, 40, 90)])
def test_against_brute_force(docs_of, rows_of, monkeypatch, min_docs, top, columns, sources):
    monkeypatch.setattr(d, "PRODUCT_COLUMNS", columns)
    monkeypatch.setattr(d, "BLOCK_TERMS", 20)
    monkeypatch.setattr(d, "BLOCK_SOURCES", 4)
    docs = cases(sources)
    got = d.source_divergence(docs_of(docs).repartition(5), min_docs, top)
    assert rows_of(got) == brute(docs, min_docs, top)


def test_joint_tables(docs_of, rows_of):
    docs = [(i, t, "en", s) for i, (t, s) in enumerate([("a a b", "x"), ("a c", "x"), ("a b b", "y"), ("c", "y"), ("d", "z")])]
    got = rows_of(d.joint_tables(docs_of(docs), min_docs=1))
    # x: a 3, b 1, c 1; y: a 1, b 2, c 1; z: d 1
    assert [r for r in got if r[1:3] == ("x", "y")] == [("en", "x", "y", 1, 1, 1), ("en", "x", "y", 1, 2, 1), ("en", "x", "y", 3, 1, 1)]
    assert [r for r in got if r[1:3] == ("x", "z")] == [("en", "x", "z", 0, 1, 1), ("en", "x", "z", 1, 0, 2), ("en", "x", "z", 3, 0, 1)]


def test_shares_of_huge_counts_are_exact(spark):
    n, total, kept = 8 * 10**17, 9 * 10**17, 10**9
    row = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long").select(d._price("n", "total", "kept")).first()
    assert row[0] == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_counts_passed_on_early(docs_of, rows_of, monkeypatch):
    monkeypatch.setattr(d, "HELD_ENTRIES", 10)
    assert rows_of(d.source_divergence(docs_of(cases()), 3)) == brute(cases(), 3, 50)


def test_empty(docs_of):
    assert d.source_divergence(docs_of([])).count() == 0
