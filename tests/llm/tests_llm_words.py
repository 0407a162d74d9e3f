"""Seeded words for the fixtures."""

import random


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]
