"""Texts for the tests: seeded random words."""

import random

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def vocabulary(n: int, seed: int = 1) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(1, 8))) for _ in range(n)]


def words(n: int, seed: int, pool: list[str] | None = None) -> list[str]:
    r = random.Random(seed)
    pool = pool or vocabulary(400)
    return [r.choice(pool) for _ in range(n)]
