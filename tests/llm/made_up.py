"""Made-up words, texts and near copies."""

import random

WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "pra", "sto", "vei", "zu", "tha") for b in ("n", "rt", "st", "x", "dle")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def near_copies(groups, size):
    """Groups of a text and copies of it with a few words changed, put in or left out."""
    rng = random.Random(17)
    docs = []
    for group in range(groups):
        base = prose(rng, rng.randint(8, 200)).split()
        for copy in range(size):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [rng.choice(WORDS) + "q"], [words[at], "more"]])
            docs.append((group * 100 + copy, " ".join(words)))
    return docs
