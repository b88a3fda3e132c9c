"""Small documents with every odd case: nulls, empty and long texts, repeated rows, copies, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, body string, score string, n_tokens string, c0 string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(("an", "er", "th", "ou", "é", "ción", "st")) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    base = [words(rng, rng.randint(8, 120)) for _ in range(n // 3)]
    passage = " ".join(words(rng, 60))
    texts: list[str | None] = []
    for k in range(n):
        w = list(rng.choice(base)) if k % 3 else words(rng, rng.randint(1, 90))
        for _ in range(rng.randint(0, 2) if k % 3 else 0):
            w[rng.randrange(len(w))] = rng.choice(words(rng, 1))
        t = " ".join(w)
        texts.append(t if k % 7 else f"{t} {passage} {t[:40]}")
    texts += [None, "", " ", "one two", "one two", "ab" * 4000, "ONE  Two\tthree four five six", "one two three four five six", texts[0]]
    out = [(k, t) for k, t in enumerate(texts)]
    out += [out[1], out[4], (None, "no id at all, but words enough to count"), (None, None), (None, texts[1])]
    return [(i, t, "en", f"s{(i or 0) % 4}" if i != 5 else None, len(t or ""), 1, "x", "y", "z", "w") for i, t in out]
