import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text), with columns whose names operators also use."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, id string, node string"
        full = [(i, t, None, "s", len(t) if t is not None else None, "x", "y", "z", "w") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def some_words():
    """Endless different words, the same on every run."""

    def build(seed, n):
        state, out = seed * 2654435761 + 1, []
        for _ in range(n):
            state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            out.append(f"w{(state >> 33) % 5000}")
        return out

    return build


@pytest.fixture(scope="session")
def odd_texts(some_words):
    """Null, empty, blank, short, repeated and very long texts."""
    base = some_words(7, 60)
    long = some_words(8, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, " ".join(base)), (7, " ".join(base)),
        (8, " ".join(base[:-1] + ["other"])), (9, " ".join(long)), (10, "same " * 200), (11, "Same same  SAME"),
        (12, "é" * 400 + " ünï \U0001f389 日本語"), (13, " ".join(long[:29_000])), (13, " ".join(long[:29_000])), (None, " ".join(base)),
    ]


def words_of(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(text)


def shingles_of(text, n, lower=True):
    w = words_of(text, lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
