import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A table of documents from texts; ids count from 0."""

    def make(texts, first=0, sources=None):
        rows = [(first + i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def corpus():
    """Texts with exact and near copies, shared passages, odd and empty ones."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, texts = text(60), []
    for n in (3, 5, 8, 9, 12, 20, 38, 39, 40, 41, 60, 150, 400):
        base = text(n).split()
        texts.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            for _ in range(max(1, n // 60)):
                copy[rng.choice([0, len(copy) - 1, rng.randrange(len(copy))])] = word()
            texts += [" ".join(copy), " ".join(copy[:-1]), " ".join([word(), *copy])]
        texts.append(("  ".join(base) + "\n").upper())
    texts += [f"{text(30)} {passage} {text(30)}" for _ in range(30)]
    texts += [None, "", " \n\t", "one", "One", "ünï çödé " * 40, "aaaa" * 200, "x" * 99, "x" * 100, "x " * 400, passage]
    rng.shuffle(texts)
    return texts


def shingles(text, k=5):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.fixture
def shingle():
    return shingles
