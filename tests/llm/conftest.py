from __future__ import annotations

import random

import pytest

EXTRA = "key string, row string, label string, votes int, spans string, length string, n_words string, `_text` string, token string"


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(2 + rng.randrange(vocabulary) % 3)) for _ in range(words))


def changed(text: str, *places: int) -> str:
    words = text.split(" ")
    for place in places:
        words[place] = f"other{place}"
    return " ".join(words)


BASE = prose(1, 300)
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (None, prose(2, 80)),
    (4, prose(3, 30_000)),
    (5, "a" * 3000),
    (6, BASE),
    (6, BASE),
    (7, BASE),
    (8, changed(BASE, 20)),
    (9, changed(BASE, 20, 290)),
    (10, "zwölf Boxkämpfer 🙂 jagen Viktor İ ß ǅ \u0000 end"),
    (11, prose(4, 3)),
    (12, prose(4, 3).upper()),
    (13, prose(5, 60) + "\n" + prose(6, 40) + "\n" + prose(6, 40)),
    (14, prose(7, 30) + " " + BASE[200:900] + " " + prose(8, 30)),
    (15, "\u0000" * 900 + "x"),
    (16, "word " * 500),
    (None, None),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with every odd case, and columns whose names operators use inside."""
    rows = [(i, t, None, None, None, *["clash"] * 3, 7, *["clash"] * 5) for i, t in TEXTS]
    rows = [(i, t, None, "s", None, "k", "r", "l", 7, "s", "n", "w", "t", "o") for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
