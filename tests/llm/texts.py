"""Made-up texts."""

from __future__ import annotations

import random
import string


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(n))
