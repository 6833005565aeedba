import random

import pytest

CLASHES = "n_words long, score double, items string, ids string, component_id long, n_lines long, t long, leaf long, host string, g long, key string"
PARTS = ["the", "of", "an", "er", "tion", "on", "re", "st", "in", "ha", "ou", "le"]


def word(rng):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with everything that may go wrong: nulls, empty, blank and very long texts, repeated rows, extra columns that clash."""
    rng = random.Random(5)
    long = "\n".join(prose(rng, 40) for _ in range(700))
    texts = [None, "", " \n\t ", "a", "...", "été 漢字 🙂 Ünder", long, "same text of a few words here", "same text of a few words here", "x " * 300]
    rows = [(k, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", 0, *[1, 0.5, "i", "1", 7, 1, 1, 1, "h", 1, "k"]) for k, t in enumerate(texts)]
    rows += [rows[7], (None, "no key", "en", "s", 0, *rows[0][5:]), (None, None, None, None, None, *rows[0][5:])]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
