import random
import zlib

import numpy as np
import pytest

from pulsewright.llm import packing as p

tokenizers = pytest.importorskip("tokenizers")


def ids_of(text, path=None):
    made = tokenizers.Tokenizer.from_file(path or p.tokenizer_file()).encode(text or "", add_special_tokens=False)
    return np.asarray([*made.ids, p.END_ID], "<u4")


ODD = ["", None, "It's don't WON'T!", "İstanbul ǅ ß", "<|endoftext|> x", "x\t\ty  z\r\n", "12ab 3.5 foo!!bar ... a. .b", "日本語。テスト", "\x00a\x01", "ﬁ Ｆｕｌｌ ΣΑΣ"]


def check(rows, docs, capacity):
    by_seq, total = {}, 0
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        total += r["length"]
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    expected = []
    for doc_id, text in docs:
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda t: [(-1 if v is None else v) for v in t]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=key) == sorted(expected, key=key)
    return len(by_seq), total


def test_pieces_and_places(docs_of):
    r = random.Random(2)
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, " ".join(r.choice(["the", "Cat.", "naïve", "42"]) for _ in range(r.randint(1, 60)))) for i in range(150)]
    docs += [(None, "no id"), (7, "same id"), (7, "same id"), (900, "long word " * 100)]
    rows = p.pack(docs_of(docs), capacity=64, buckets=4).collect()
    sequences, total = check(rows, docs, 64)
    assert sequences <= -(-total // 64) + 2


@pytest.mark.parametrize("limit", [700_000, 5])
def test_remembered_parts_give_the_tokenizers_ids(limit):
    """Parts are learnt one by one: none can take another's ids, in whatever order generations change."""
    encode, r = p.PackedTokens(p.tokenizer_file(), limit), random.Random(4)
    pieces = [*"aZéÉİıßŉªº'.!, \nſµŸΣ\u0301日9<|ﬁ\u0307", "the", "Naïve", "\u200b", "x" * 300]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 20))) for _ in range(3000)] + [t for t in ODD if t]
    assert [encode(t) for t in texts] == [
        np.asarray(x.ids, "<u4").tobytes() for x in encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    ]
    assert len(encode.known) <= limit + 60 and all(len(x) <= encode.known.LONGEST for x in encode.known)


def test_empty_table(docs_of):
    assert p.pack(docs_of([])).count() == 0


def optimum(lengths, capacity):
    """Fewest bins by search."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                go(i + 1, [*rest, room - lengths[i]])
        go(i + 1, [*bins, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_plan_places_every_rank_once_and_reduction_is_safe():
    r = random.Random(4)
    for _ in range(60):
        capacity = r.choice([10, 16, 25])
        lengths = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 9))), reverse=True)
        histogram = {n: lengths.count(n) for n in lengths}
        runs, sequences = p.plan(histogram, capacity)
        ranks, used = {}, {}
        for length, first, n, seq, offset in runs:
            for k in range(n):
                ranks.setdefault(length, []).append(first + k)
                used.setdefault(seq + k, []).append((offset, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in histogram.items()}
        assert len(used) == sequences
        best = optimum(lengths, capacity)
        assert best <= sequences <= best + 1
        # The fixed sets alone leave an instance that can still reach the optimum.
        stock = p._Stock(histogram)
        fixed = p.reduce_by_dominance(stock, capacity, 0, [])
        rest = [n for n, k in stock.left.items() for _ in range(k)]
        assert fixed + optimum(sorted(rest, reverse=True), capacity) == best


def test_large_histogram_gives_a_bounded_plan():
    r = random.Random(6)
    histogram = {n: r.randint(1, 10**7) for n in range(1, 4097, 3)}
    runs, sequences = p.plan(histogram)
    total = sum(n * k for n, k in histogram.items())
    assert len(runs) < 100_000
    assert sequences * 4096 < total * 1.02
