"""Rows for the tests, from a rule."""

import re

TEXT = ("the quick brown fox jumps over a lazy dog and then runs far away from all the hounds that chase it through "
        "wet fields under dark clouds while nobody watches the long road home ").split()


def words(n, seed):
    """n words that depend on the seed, from a rule."""
    return [f"{TEXT[(seed * 7 + i * (seed % 5 + 1)) % len(TEXT)]}{(seed * 31 + i * i) % 97}" for i in range(n)]


SHARED = " ".join(words(40, 9))
ROWS = [
    (1, " ".join(words(60, 1))),
    (2, " ".join(words(60, 1))),                                    # exact copy
    (3, " ".join(words(60, 1)[:-1] + ["other"])),                   # near copy
    (4, " ".join(words(30, 2)) + " " + SHARED + " " + " ".join(words(30, 3))),
    (5, SHARED.upper() + " " + SHARED),
    (6, None), (7, ""), (8, " \t\n "), (9, "one two"), (10, "One  TWO"),
    (11, "a " * 300), (12, " ".join(words(20000, 4))),               # runs; a very long text
    (13, " ".join(words(20000, 4)[:15000]) + " end"),
    (14, "Äpfel über élève 你好 " * 12), (14, "Äpfel über élève 你好 " * 12),   # a repeated row
    (None, " ".join(words(60, 1))), (15, "=" * 700), (16, "x" + "=" * 650),
]


def blank_words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", text)
