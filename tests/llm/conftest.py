"""Fixtures of documents with the awkward cases every operator must define."""

import random

import pytest


def make_documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, empties, long texts."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 9))) for _ in range(300)]

    def prose(k):
        return "".join(rnd.choice(vocab) + rnd.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(k))

    passage, texts = prose(70), [None, "", " ", "one", "a b c d", "Ünï — 漢字　x", "x" * 700, "ab" * 500, "the same " * 90]
    base = prose(120)
    for _ in range(n - len(texts)):
        kind = rnd.random()
        if kind < 0.2:
            texts.append(base)
        elif kind < 0.45:
            words = base.split(" ")
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
            texts.append(" ".join(words))
        elif kind < 0.65:
            texts.append(prose(rnd.randint(1, 60)) + passage + prose(rnd.randint(0, 60)))
        else:
            texts.append(prose(rnd.randint(1, 150)))
    texts.append(prose(4000))
    rows = [(3 * i + 2, t, ["en", "fr", None][i % 3], "src0" if i % 3 else f"src{i % 7}",
             None if t is None else len(t)) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(make_documents(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
